"""Phrases whose words keep each other's company, from one count of the longest windows.

Each word starts one window: itself and the two words that follow within its piece of text, empty
where the piece has ended. These lead columns ``w1, w2, w3`` are counted as they are, and nothing
else is: every occurrence of a shorter phrase begins some window, so ``ROLLUP (w1, w2)`` over the
counted windows sums them to the counts of pairs, of words, and of all words of a language.

A phrase of two or three words that occurs at least ``LEAST`` times is a candidate. Its score is the
lowest of ``floor(10^6 a^2 / (l r))`` over the places to cut it in two, with a, l and r the counts of
the phrase and its parts, in whole numbers of up to 38 digits. Pairs that lie in a candidate of three
words at least half as frequent are dropped.

What is shuffled is kept short. A word that is not frequent enough by itself is in no candidate, so
windows end before it (and it is counted as a word). The others travel as numbers, a window as one
number of three. They are listed in a *code book* of at most ``CODES`` words, which every task holds.
Where more words than that are frequent, windows end before the others too, and windows with any of
these are counted as they are in a second pass: no phrase is in both, and results do not depend on
the size of the book.

Cases: null texts are empty, null languages are ``und``; words go by their bytes, A-Z in lower case;
texts and pieces of any length are read whole, in blocks; repeated rows count each; an empty table
gives no rows. Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import keep, map_batches, small, store

LEAST = 10
INSIDE = 50
TOP = 2_000
SCALE = 1_000_000

#: A word takes so many bits of a window; none is 0.
BITS = 21
CODES = 2**BITS // 4
#: Words, windows or different words a task holds before it hands them on.
HELD = 1_000_000
#: Longer texts are cut into words a block at a time.
LONG_TEXT = 1 << 20
BLOCK = 100_000

#: Pieces end at these; as none is part of a word, one of them can stand for all.
_ENDS = b".,;:!?\n\v\f\r"
_END = bytes.maketrans(_ENDS, b"." * len(_ENDS))
#: Stands before words that are not in the book; no word holds it.
_MARK = b"\v"


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, two ends between pieces; a long text in blocks."""
    parted = text.lower().translate(_END).replace(b".", b" . . ")
    if len(text) <= LONG_TEXT:
        yield parted.split()
        return
    words = (m[0] for m in re.finditer(rb"[^ \t]+", parted))
    while block := list(islice(words, BLOCK)):
        yield block


def _languages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts):
            yield lang, text.as_py()


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words per language, added up within the task."""

    def handed(held: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            words.pop(b".", None)
            columns = [pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "n"])

    held: dict[str, Counter] = {}
    for lang, text in _languages(batches):
        words = held.setdefault(lang, Counter())
        for block in _blocks(text):
            words.update(block)
            if len(words) >= HELD:
                yield from handed({lang: held.pop(lang)})
                words = held.setdefault(lang, Counter())
    yield from handed(held)


class _Codes(dict):
    """Numbers of words from 1; ends of pieces and words that are not in the book are 0."""

    def __missing__(self, word: bytes) -> int:
        return 0


@lru_cache(maxsize=1)
def _listed(book: bytes) -> list[bytes]:
    return book.split(b"\n")


@lru_cache(maxsize=1)
def _coded(book: bytes) -> _Codes:
    return _Codes((word, n) for n, word in enumerate(_listed(book)) if n)


def code_book(named: DataFrame, least: int, codes: int) -> tuple[bytes, bool]:
    """The most frequent words, a line each after an empty one, and whether these are all frequent ones."""
    counted = map_batches(named, _words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    frequent = counted.filter(F.col("n") >= least).groupBy("word").agg(F.sum("n").alias("n"))
    frequent = store(frequent, "words")
    # The least count of the words in the book is read off a table of counts in steps of 1/16 of a
    # power of two, which has at most a thousand lines.
    step = F.floor(F.log2("n") * 16).cast("int")
    by_step = sorted(frequent.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect(), reverse=True)
    taken, lowest = 0, None
    for row in by_step:
        taken += row["words"]
        if taken > codes:
            break
        lowest = row["step"]
    chosen = [] if lowest is None else frequent.filter(step >= lowest).select("word").toArrow()["word"].to_pylist()
    return b"\n".join([b"", *sorted(word.encode() for word in chosen)]), taken <= codes


def _numbers(blocks: Iterator[list[bytes]], codes: _Codes) -> Iterator[tuple[np.ndarray, int]]:
    """Windows that begin at a word of the book, block by block, and how many words are not in it."""
    carried = np.zeros(0, np.int64)
    for block in blocks:
        new = np.fromiter(map(codes.__getitem__, block), np.int64, len(block))
        row = np.concatenate([carried, new])
        yield _packed(row), int((new == 0).sum()) - block.count(b".")
        carried = row[-2:]
    yield _packed(np.concatenate([carried, np.zeros(2, np.int64)])), 0


def _packed(row: np.ndarray) -> np.ndarray:
    """Each three numbers in a row as one; what follows a 0 is 0, and windows do not begin with one."""
    if len(row) < 3:
        return row[:0]
    first, second, third = row[:-2], row[1:-1], row[2:]
    key = (first << 2 * BITS) | (second << BITS) | np.where(second > 0, third, 0)
    return key[first > 0]


def _joined(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    """The words of several texts, with two ends after each."""
    for text in texts:
        yield from _blocks(text)
        yield [b".", b"."]


def windows(named: DataFrame, book: bytes) -> DataFrame:
    """(lang, key, n): windows as numbers, and how often; under 0 the words that begin none."""
    shared = named.sparkSession.sparkContext.broadcast(book)

    def handed(lang: str, held: list[np.ndarray], other: int) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True)
        keys, counts = np.append(keys, 0), np.append(counts, other)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts)], names=["lang", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _coded(shared.value)
        held: dict[str, list] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            texts = batch.column("text").cast(pa.binary())
            for lang in dict.fromkeys(langs):
                own = held.setdefault(lang, [[], 0, 0])
                chosen = (texts[int(i)].as_py() for i in np.flatnonzero(langs == lang))
                for keys, other in _numbers(_gathered(_joined(chosen)), codes):
                    own[0].append(keys)
                    own[1] += len(keys)
                    own[2] += other
                    if own[1] >= HELD:
                        yield handed(lang, own[0], own[2])
                        own[:] = [], 0, 0
        for lang, (keys, _, other) in held.items():
            yield handed(lang, keys, other)

    return map_batches(named, run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _gathered(blocks: Iterator[list[bytes]]) -> Iterator[list[bytes]]:
    """Blocks of at least BLOCK words, of what comes in smaller ones."""
    gathered: list[bytes] = []
    for block in blocks:
        gathered += block
        if len(gathered) >= BLOCK:
            yield gathered
            gathered = []
    yield gathered


def plain_windows(named: DataFrame, book: bytes) -> DataFrame:
    """(lang, w1, w2, w3, n): the windows that hold a word that is not in the book, such words marked."""
    shared = named.sparkSession.sparkContext.broadcast(book)

    def handed(lang: str, held: Counter) -> pa.RecordBatch:
        words = [pa.array([key[i] for key in held], pa.binary()).cast(pa.string()) for i in range(3)]
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), *words, pa.array(list(held.values()), pa.int64())], names=["lang", "w1", "w2", "w3", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _coded(shared.value)
        held: dict[str, Counter] = {}
        for lang, text in _languages(batches):
            carried: list[bytes] = []
            for block in (*_blocks(text), [b".", b"."]) if len(text) <= LONG_TEXT else _joined(iter([text])):
                row = carried + [b"" if w == b"." else w if w in codes else _MARK + w for w in block]
                counted = held.setdefault(lang, Counter())
                for first, second, third in zip(row, row[1:], row[2:]):
                    third = third if second else second
                    if first and _MARK in first[:1] + second[:1] + third[:1]:
                        counted[first, second, third] += 1
                if len(counted) >= HELD:
                    yield handed(lang, held.pop(lang))
                carried = row[-2:]
        for lang, counted in held.items():
            yield handed(lang, counted)

    counted = map_batches(named, run, "lang string, w1 string, w2 string, w3 string, n long")
    return counted.groupBy("lang", "w1", "w2", "w3").agg(F.sum("n").alias("n"))


def prefixes(counted: DataFrame, least: int) -> DataFrame:
    """lang, w1, w2, w3, n, words of windows and their prefixes that occur often enough; ``words`` is
    how many a prefix has, 0 for all words of a language, and the rest are null.

    Tests of the words themselves come after this is stored: they would be made before the windows are
    summed, and these then be counted once more for the prefixes.
    """
    longest = counted.filter(F.col("n") >= least).select("lang", "w1", "w2", "w3", "n", F.lit(3).alias("words"))
    summed = counted.sparkSession.sql(
        "SELECT lang, w1, w2, sum(n) AS n, grouping_id() AS out FROM {counted} GROUP BY lang, ROLLUP (w1, w2)", counted=counted
    )
    words = F.when(F.col("out") == 0, 2).when(F.col("out") == 1, 1).otherwise(0)
    shorter = summed.filter((F.col("n") >= least) | (F.col("out") == 3))
    none = F.lit(None).cast(counted.schema["w3"].dataType)
    return longest.unionByName(shorter.select("lang", "w1", "w2", none.alias("w3"), "n", words.alias("words")))


def counts(named: DataFrame, least: int = LEAST, codes: int = CODES) -> DataFrame:
    """lang, w1, w2, w3, n, words of phrases that occur often enough, null after their last word."""
    book, whole = code_book(named, least, codes)
    place = lambda i: F.shiftright("key", (2 - i) * BITS).bitwiseAND(2**BITS - 1).alias(f"w{i + 1}")
    counted = windows(named, book).select("lang", place(0), place(1), place(2), "n")
    grams = store(prefixes(counted, least), "phrases")
    # A prefix that ends with no word is a shorter one and counted as such.
    last = F.when(F.col("words") == 3, F.col("w3")).when(F.col("words") == 2, F.col("w2")).when(F.col("words") == 1, F.col("w1"))
    found = spelled(grams.filter((F.col("words") == 0) | (last != 0)), book)
    if whole:
        return found
    marked = store(prefixes(plain_windows(named, book), least), "plain-phrases")
    mark = F.lit(_MARK.decode())
    held = F.concat_ws("", "w1", "w2", "w3").contains(mark) & (F.coalesce(last, F.lit("")) != "") & (F.col("words") > 0)
    own = marked.filter(held).select("lang", *(F.regexp_replace(f"w{i}", mark, F.lit("")).alias(f"w{i}") for i in (1, 2, 3)), "n", "words")
    return found.unionByName(own)


def spelled(grams: DataFrame, book: bytes) -> DataFrame:
    """Numbers of the book's words in the columns w1, w2 and w3 as the words they stand for."""
    shared = grams.sparkSession.sparkContext.broadcast(book)
    names = ("w1", "w2", "w3")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = pa.array(_listed(shared.value), pa.binary()).cast(pa.string())
        for batch in batches:
            columns = [words.take(batch.column(c)) if c in names else batch.column(c) for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return map_batches(grams, run, ", ".join(f"{c} {'string' if c in names else t}" for c, t in grams.dtypes))


def score(a: Column, first: Column, rest: Column) -> Column:
    """floor(SCALE a^2 / (first rest)), exactly."""
    whole = lambda c: c.cast("decimal(15,0)")
    square = F.lit(SCALE).cast("decimal(7,0)") * whole(a) * whole(a)
    return F.call_function("div", square, whole(first) * whole(rest))


def scored(grams: DataFrame, inside: int = INSIDE) -> DataFrame:
    """lang, w1, w2, w3, a, l, r, score of the candidates that no longer one makes needless."""
    ones, twos = grams.filter("words = 1"), grams.filter("words = 2")
    threes = grams.filter("words = 3").withColumnRenamed("n", "a").drop("words")

    def of_one(word: str, n: str) -> DataFrame:
        return ones.select("lang", F.col("w1").alias(word), F.col("n").alias(n))

    def of_two(first: str, second: str, n: str) -> DataFrame:
        return twos.select("lang", F.col("w1").alias(first), F.col("w2").alias(second), F.col("n").alias(n))

    pieces = F.explode(F.array(*(F.struct(F.col(x).alias("w1"), F.col(y).alias("w2")) for x, y in (("w1", "w2"), ("w2", "w3")))))
    covered = threes.select("lang", pieces.alias("p"), "a").groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    pairs = (
        twos.withColumnRenamed("n", "a").join(covered, ["lang", "w1", "w2"], "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < inside * F.col("a")))
        .join(of_one("w1", "l"), ["lang", "w1"]).join(of_one("w2", "r"), ["lang", "w2"])
        .withColumn("score", score(F.col("a"), F.col("l"), F.col("r")))
    )
    cut = (
        threes.join(of_one("w1", "l1"), ["lang", "w1"]).join(of_one("w3", "r2"), ["lang", "w3"])
        .join(of_two("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(of_two("w1", "w2", "l2"), ["lang", "w1", "w2"])
        .withColumn("s1", score(F.col("a"), F.col("l1"), F.col("r1"))).withColumn("s2", score(F.col("a"), F.col("l2"), F.col("r2")))
    )
    later = F.col("s2") < F.col("s1")
    pick = lambda name: F.when(later, F.col(f"{name}2")).otherwise(F.col(f"{name}1"))
    triples = cut.select("lang", "w1", "w2", "w3", "a", pick("l").alias("l"), pick("r").alias("r"), pick("s").alias("score"))
    return pairs.select(triples.columns).unionByName(triples)


def phrases(docs: DataFrame, least: int = LEAST, inside: int = INSIDE, top: int = TOP, codes: int = CODES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language."""
    named = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    grams = store(counts(named, least, codes), "grams")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored(grams, inside).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    first = ranked.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    of_lang = grams.filter("words = 0").select("lang", "n")
    return first.join(small(keep(of_lang)), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
