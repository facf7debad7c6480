"""Toxic texts by class-conditional Kneser-Ney models of how words are spelled.

A word, A-Z in lower case, is a run of bytes between two marks. Each byte is predicted from up to
``ORDER`` before it, in its word. Toxic and ordinary texts have counts of their own at the longest
context; an absolute discount is taken off them and given to the shorter contexts, whose
distributions are shared: there, a byte counts as often as it follows different longer contexts in
either class. So a rare spelling is about as likely in both, and what tells them apart is what one
class has often and the other has not.

Per word, the difference of the two log-likelihoods is averaged over each ``STRETCH`` words in a row,
wherever they begin, or over all words of a text that has fewer; a text has the value of its most
toxic stretch. A logistic curve turns values into scores. It is fitted on every fourth labelled text, which the
models it is fitted for have not seen; the final models count all labelled texts.

Counts cover all labelled texts, are summed by Spark, and are exact. They grow with the corpus: tasks
hold them in slices of a bounded size (``grams``), each of which gives its part of every word.

Cases: a text without words, or null, has the value 0, and the score that belongs to it; a labelled
id without text teaches nothing; an id labelled both ways counts for both; without labelled texts
of both classes all scores are 0; repeated rows get equal scores; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import keep, map_batches, small, store
from tillroll.llm.grams import BITS, SLICE, Table, in_slice, ours, slice_numbers, table_of
from tillroll.llm.kernels import Words, chunks, rows_of

ORDER = 4
STRETCH = 8
DISCOUNT = 0.75
BINS = 2000
#: Values beyond this many nats a word are put in the outermost bins of the calibration.
SPAN = 10.0
#: The curve rises at least so much a nat, however few texts calibrate it.
LEAST_SLOPE = 0.5

_END, _START = 256, 257
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256)
_LOWER[65:91] += 32


def spelled(words: Words, data: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte and end mark of some words as one number with its context: (gram, context length, word).

    A gram has nine bits for a symbol plus one, the last symbol lowest, up to ORDER before it.
    """
    start, length = words.start[which], words.end[which] - words.start[which]
    word = np.repeat(np.arange(len(which)), length + 1)
    place = np.arange(len(word)) - np.repeat(np.cumsum(length + 1) - length - 1, length + 1)
    symbol = np.full(len(word), _END)
    inner = place < length[word]
    symbol[inner] = _LOWER[data[(start[word] + place)[inner]]]
    gram = symbol + 1
    for back in range(1, ORDER + 1):
        before = np.zeros(len(word), np.int64)
        before[back:] = np.where(place[back:] >= back, symbol[: max(0, len(word) - back)] + 1, 0)
        before[place == back - 1] = _START + 1
        gram = gram | before << (BITS * back)
    return gram, np.minimum(place + 1, ORDER), word


def cut(gram: np.ndarray, length: int) -> np.ndarray:
    """A gram with its context shortened to so many symbols."""
    return gram & ((1 << BITS * (length + 1)) - 1)


@dataclass
class Models:
    """One slice of the counts of both classes; ``of`` is the column of each class in the tables."""

    grams: Table  # counts at the longest context, by class
    contexts: Table  # their sums by context, and what the discount takes off them
    follows: Table  # different longer contexts of a gram
    after: Table  # the same summed over the successors of a context, and how many successors
    of: tuple[int, int]
    nth: int
    numbers: Table | None

    def differences(self, words: Words, data: np.ndarray) -> np.ndarray:
        """What the slice adds to the log-likelihood of each word as toxic less that as ordinary."""
        _, first, same = np.unique(words.hash, return_index=True, return_inverse=True)
        gram, length, word = spelled(words, data, first)
        own = ours(gram >> BITS, self.nth, self.numbers)
        gram, length, word = gram[own], length[own], word[own]
        shared = np.full(len(gram), 1 / 258)
        for n in range(ORDER):
            at = np.flatnonzero(length > n)
            cut_to = cut(gram[at], n)
            seen, kinds = self.after[cut_to >> BITS].T
            kept = np.maximum(self.follows[cut_to][:, 0] - DISCOUNT, 0) + DISCOUNT * kinds * shared[at]
            shared[at] = np.where(seen > 0, kept / np.maximum(seen, 1), shared[at])
        counts, context = self.grams[gram], self.contexts[gram >> BITS]
        log = []
        for kind in self.of:
            seen, freed = context[:, kind], context[:, kind + self.grams.values.shape[1]]
            kept = np.maximum(counts[:, kind] - DISCOUNT, 0) + freed * shared
            log.append(np.log(np.where(seen > 0, kept / np.maximum(seen, 1), shared)))
        return np.bincount(word, log[1] - log[0], len(first))[same]

    def add(self, texts: pa.Array, before: pa.Array | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(sums of each word, offsets of rows) of some texts at a time, with those of slices before."""
        for lo, hi, data, offsets in chunks(texts, 1 << 19):
            words = Words(data, offsets, _SEPARATOR)
            found = self.differences(words, data) if len(words.start) else np.zeros(0)
            if before is not None:
                found = found + np.frombuffer(b"".join(before.slice(lo, hi - lo).to_pylist()), np.float64)
            yield found, words.offsets


def most(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The highest mean of STRETCH words in a row of each text, of all words where there are fewer; 0 without."""
    total = np.concatenate([[0.0], np.cumsum(sums)])
    counts = np.diff(offsets)
    width = np.minimum(counts, STRETCH)
    n = np.where(counts > 0, counts - width + 1, 0)
    row = rows_of(np.concatenate([[0], np.cumsum(n)]))
    at = offsets[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    means = (total[at + width[row]] - total[at]) / np.maximum(width[row], 1)
    out = np.zeros(len(counts))
    has = n > 0
    if has.any():
        out[has] = np.maximum.reduceat(means, (np.cumsum(n) - n)[has])
    return np.round(out, 9)  # the running total depends on the texts before


def count_spellings(labelled: DataFrame) -> DataFrame:
    """(gram, n00, n01, n10, n11) of rows (toxic, calibrates, text): one count per class and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in range(4)]
        for batch in batches:
            group = 2 * batch.column(0).to_numpy() + batch.column(1).to_numpy()
            for lo, hi, data, offsets in chunks(batch.column(2), 1 << 19):
                words = Words(data, offsets, _SEPARATOR)
                of = group[lo:hi][rows_of(words.offsets)]
                for g in np.unique(of):
                    own = np.flatnonzero(of == g)
                    _, first, times = np.unique(words.hash[own], return_index=True, return_counts=True)
                    gram, _, word = spelled(words, data, own[first])
                    grams, at = np.unique(np.concatenate([found[g][0], gram]), return_inverse=True)
                    found[g] = grams, np.bincount(at, np.concatenate([found[g][1], times[word]]), len(grams))
        for g, (grams, n) in enumerate(found):
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams), pa.array(np.full(len(grams), g, np.int32)), pa.array(n.astype(np.int64))],
                ["gram", "part", "n"],
            )

    parts = map_batches(labelled, run, "gram long, part int, n long")
    sums = [F.sum(F.when(F.col("part") == g, F.col("n")).otherwise(0)).alias(f"n{g:02b}") for g in range(4)]
    return parts.groupBy("gram").agg(*sums)


def fit(labelled: DataFrame, size: int = SLICE) -> tuple[list[Models], list[Models], bool]:
    """Models of all rows (toxic, calibrates, text), and of those that do not calibrate, slice by slice;
    and whether there are texts of both classes."""
    counts = store(count_spellings(labelled), "spellings")
    total = [F.col("n00") + F.col("n01"), F.col("n10") + F.col("n11"), F.col("n00"), F.col("n10")]
    names = ["all0", "all1", "rest0", "rest1"]
    top = counts.select("gram", F.shiftright("gram", BITS).alias("context"), *(c.alias(k) for c, k in zip(total, names)))
    freed = [F.sum(F.least(F.col(k), F.lit(DISCOUNT))).alias(f"freed_{k}") for k in names]
    contexts = top.groupBy("context").agg(*(F.sum(k).alias(k) for k in names), *freed)

    lengths = [F.lit((1 << BITS * (n + 1)) - 1) for n in range(ORDER + 1)]
    shorter = F.filter(F.transform(F.array(*lengths), lambda m: F.col("gram").bitwiseAND(m)), lambda g: g <= F.col("gram"))
    every = counts.select(F.explode(F.array_distinct(shorter)).alias("gram")).distinct()
    # The highest symbol goes: the longest mask below the gram.
    less = F.array_max(F.filter(F.array(*lengths[:-1]), lambda m: m < F.col("gram")))
    shared = store(every.filter(less.isNotNull()).groupBy(F.col("gram").bitwiseAND(less).alias("gram")).agg(F.count("*").alias("follows")), "follows")
    after = shared.groupBy(F.shiftright("gram", BITS).alias("context")).agg(F.sum("follows").alias("all_follow"), F.count("*").alias("kinds"))

    rows, *both = top.agg(F.count("*"), F.sum("all0"), F.sum("all1"), F.sum("rest0"), F.sum("rest1")).first()
    n = 1 + rows // size
    numbers = slice_numbers(labelled.sparkSession, n)
    out: tuple[list[Models], list[Models]] = [], []
    for i in range(n):
        of_gram, of_context = in_slice(F.shiftright("gram", BITS), i, n), in_slice(F.col("context"), i, n)
        held = (
            table_of(top.filter(of_gram).drop("context"), "gram"),
            table_of(contexts.filter(of_context), "context"),
            table_of(shared.filter(of_gram), "gram"),
            table_of(after.filter(of_context), "context"),
        )
        out[0].append(Models(*held, (0, 1), i, numbers))
        out[1].append(Models(*held, (2, 3), i, numbers))
    return *out, bool(both[0] and both[1])


def valued(rows: DataFrame, models: list[Models]) -> DataFrame:
    """The columns of rows but ``text``, with ``value`` of the text.

    Where the models have several slices, the sums of words so far are written beside the texts.
    """
    kept = [f for f in rows.schema if f.name != "text"]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]

    def step(frame: DataFrame, model: Models, last: bool) -> DataFrame:
        sent, started = frame.sparkSession.sparkContext.broadcast(model), "__sums" in frame.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(len(kept))
                found = list(sent.value.add(texts, batch.column(len(kept) + 1) if started else None))
                own = batch.columns[: len(kept)]
                if last:
                    made = [pa.array(np.concatenate([np.zeros(0), *(most(*x) for x in found)]))]
                else:
                    made = [texts, pa.array([part.tobytes() for sums, at in found for part in np.split(sums, at[1:-1])], pa.binary())]
                yield pa.RecordBatch.from_arrays([*own, *made], [*(f.name for f in kept), *(["value"] if last else ["text", "__sums"])])

        ends = ["value double"] if last else ["text string", "__sums binary"]
        return map_batches(frame, run, ", ".join([*columns, *ends]))

    frame = rows.select(*(f.name for f in kept), "text")
    for i, model in enumerate(models):
        last = i == len(models) - 1
        frame = step(frame, model, last)
        frame = frame if last else store(frame, "word-sums")
    return frame


def curve(found: DataFrame) -> tuple[float, float]:
    """Slope and middle of a logistic curve for rows (toxic, value), by counts in BINS bins."""
    bin_of = F.floor((F.col("value") + SPAN) / (2 * SPAN) * BINS)
    counted = found.groupBy("toxic", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), bin_of)).alias("bin")).count().toArrow()
    n = np.zeros((2, BINS))
    n[counted["toxic"], counted["bin"]] = counted["count"]
    x = (np.arange(BINS) + 0.5) / BINS * 2 * SPAN - SPAN
    at = np.stack([x, np.ones(BINS)])
    w = np.zeros(2)
    ridge = np.array([1e-2, 1e-4])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(w @ at, -30, 30)))
        slope = at @ (n.sum(0) * p - n[1]) + ridge * w
        step = np.linalg.solve((at * (n.sum(0) * p * (1 - p))) @ at.T + np.diag(ridge), slope)
        w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        w[0] = max(w[0], LEAST_SLOPE)
    return float(w[0]), float(-w[1] / w[0])


def scored(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, held_out, score and predicted; only ids for which ``learn`` holds teach."""
    taught = labels.filter(learn & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int"))
    calibrates = (F.pmod(F.floor(F.crc32(F.col("doc_id").cast("string")) / 5), F.lit(4)) == 0).cast("int")
    known = docs.select("doc_id", "text").filter("text IS NOT NULL").join(small(keep(taught)), "doc_id")
    known = known.select("toxic", calibrates.alias("calibrates"), "text")
    held_out = F.coalesce(~learn, F.lit(False)).alias("held_out")
    final, rest, both = fit(known)
    if not both:
        return docs.select("doc_id", held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    slope, middle = curve(valued(known.filter("calibrates = 1").drop("calibrates"), rest))
    score = 1 / (1 + F.exp(F.least(F.lit(50.0), F.lit(slope) * (F.lit(middle) - F.col("value")))))
    found = valued(docs.select("doc_id", held_out, "text"), final).withColumn("score", score)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents, learned from labels whose crc32 of the id is no multiple of 5."""
    return scored(docs, labels, F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
