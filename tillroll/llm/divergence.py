"""How far the sources of a language differ: between each two, and the terms each favours most.

Terms are counted per (lang, source); a language keeps those in at least ``DOCUMENTS`` of its
documents. With N occurrences of V kept terms, a group gives a term that it holds c times the share
``p = 1 + floor(SCALE * (c + ADDED) / (N + ADDED * V))``, and likewise the language. All of it is
whole numbers.

**Terms.** The terms a group favours are ranked by its share less the language's. A term *dominates*
another if it is no rarer in the group, no more frequent in the language, and earlier in UTF-8; it
then stands before it, whatever N and V are. So a term with ``TOP`` dominators cannot be among the
first TOP, and only the *skyband* has to be ranked: the terms with fewer dominators. Each task keeps
the skyband of what it reads, a batch at a time; skybands of parts are merged to that of the whole,
since a term's first TOP dominators are in the skyband themselves. The merged one is ranked exactly.

**Pairs.** The distance of two sources is the sum of differences over all kept terms, held by either
or not. Sources are numbered per language and cut into blocks of ``BLOCK``; a task takes a slice of
the terms for one pair of blocks, lays the shares out as a table with a row per term, and adds up
differences there. Terms that neither block holds count by their number. So the work of a language
with many sources is dealt by blocks, and one term's row never holds more than two blocks.

Cases: null text, lang and source are empty strings; a language without kept terms has pairs of
value 0 and no terms; a group without terms is compared like any other; a lone source has no pairs;
repeated rows count as documents each; texts of any length are read whole; an empty table gives no
rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import keep, map_batches, small, store

DOCUMENTS = 30
SCALE = 1_000_000_000
ADDED = 5
TOP = 50
BLOCK = 128

#: Different terms a task holds before it hands them on.
HELD = 400_000
#: Longer texts are cut into terms a block at a time.
LONG_TEXT = 1 << 20
BLOCK_TERMS = 100_000
#: Rows a task reads, besides twice the skyband it holds, before it takes the skyband of all.
MERGED = 50_000
#: Kept rows that a task lays out for a pair of blocks.
LAID = 100_000
#: Rows of a table of shares, and candidates compared at once.
ROWS = 512

#: Terms are letters and all beyond ASCII; bytes and characters give the same ones.
_APART = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))

COUNTED = "lang string, source string, term string, n long, docs long"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, A-Z in lower case, which is all that ``bytes.lower`` changes; a long text in blocks."""
    parted = text.lower().translate(_APART)
    if len(text) <= LONG_TEXT:
        yield parted.split()
        return
    found = (m[0] for m in re.finditer(rb"[^ ]+", parted))
    while block := list(islice(found, BLOCK_TERMS)):
        yield block


def _handed(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array(list(map(docs.__getitem__, terms)), pa.int64()),
            ],
            names=["lang", "source", "term", "n", "docs"],
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group, added up within the task."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, different = len(counts), set()
            for block in _terms(text.as_py()):
                counts.update(block)
                different.update(block)
            docs.update(different)
            size += len(counts) - before
            if size >= HELD:
                yield from _handed(held)
                held, size = {}, 0
    yield from _handed(held)


def counts(docs: DataFrame, documents: int = DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Kept terms (lang, source, term, n, in_lang) and groups (lang, source, nth, total, lang_total, terms, rows)."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    held = map_batches(named, _counted, COUNTED).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    summed = held.withColumn("in_lang", F.sum("n").over(of_term)).withColumn("in_docs", F.sum("docs").over(of_term))
    kept = store(summed.filter(F.col("in_docs") >= documents).select("lang", "source", "term", "n", "in_lang"), "terms")

    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_term = kept.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    different = by_term.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"), F.sum("rows").alias("rows"))
    none = F.lit(0).cast("long")
    groups = (
        named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(different, ["lang"], "left")
        .select("lang", "source", *(F.coalesce(c, none).alias(c) for c in ("total", "lang_total", "terms", "rows")))
        .withColumn("nth", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
    )
    return kept, keep(groups)


def share(n: Column, total: Column, terms: Column) -> Column:
    """p of n occurrences, exactly; null where no term is kept."""
    whole = total.cast("decimal(19,0)") + terms.cast("decimal(18,0)") * ADDED
    part = (n.cast("decimal(19,0)") + ADDED) * F.lit(SCALE).cast("decimal(10,0)")
    return F.when(terms > 0, F.call_function("div", part, whole) + 1)


# --- terms


def skyband(group: np.ndarray, in_group: np.ndarray, in_lang: np.ndarray, term: np.ndarray, k: int) -> np.ndarray:
    """Which rows have fewer than k dominators in their group; ``term`` are places in UTF-8 order.

    Rows are taken by falling count in the group, then rising count in the language, then term, so
    that dominators come first, and are held against the skyband so far and their own chunk.
    """
    kept = []
    order = np.lexsort((term, in_lang, -in_group, group))
    bounds = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
    for lo, hi in zip(bounds, bounds[1:]):
        own = order[lo:hi]
        band = own[:0]
        for at in range(0, len(own), ROWS):
            chunk = own[at : at + ROWS]
            before = np.concatenate([band, chunk])
            by = (
                (in_group[before][None, :] >= in_group[chunk][:, None])
                & (in_lang[before][None, :] <= in_lang[chunk][:, None])
                & (term[before][None, :] < term[chunk][:, None])
            )
            band = np.concatenate([band, chunk[by.sum(axis=1) < k]])
        kept.append(band)
    return np.concatenate(kept) if kept else order


def _banded(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        most = size = 0

        def banded() -> list[pa.RecordBatch]:
            both = pa.Table.from_batches(held).combine_chunks()
            numbered = [both.column(c).chunk(0).dictionary_encode() for c in ("lang", "source")]
            lang, source = (c.indices.to_numpy().astype(np.int64) for c in numbered)
            group = lang * len(numbered[1].dictionary) + source
            place = np.empty(both.num_rows, np.int64)  # a term is in a group once, so ties do not matter
            place[pc.sort_indices(both.column("term").cast(pa.binary())).to_numpy()] = np.arange(both.num_rows)
            rows = skyband(group, both.column("n").to_numpy(), both.column("in_lang").to_numpy(), place, k)
            return both.take(pa.array(rows)).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= 2 * most + MERGED:
                held = banded()
                most = size = sum(b.num_rows for b in held)
        if size:
            yield from banded()

    return run


def favoured(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the terms each group has more of than its language."""
    rows = kept.filter(F.col("n") > 0)
    band = map_batches(rows, _banded(top), rows.schema)
    # Two steps: a group's rows are merged in parts by term, then what is left of them.
    for parts in (16, 1):
        dealt = band.repartition("lang", "source", F.pmod(F.xxhash64("term"), F.lit(parts)))
        band = map_batches(dealt, _banded(top), rows.schema)
    known = band.join(small(groups), ["lang", "source"])
    value = share(F.col("n"), F.col("total"), F.col("terms")) - share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    ranked = known.select("lang", "source", F.col("term").alias("item"), value.alias("value")).filter(F.col("value") > 0)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return ranked.withColumn("rank", place).filter(F.col("rank") <= top)


# --- pairs

_TILE = ["lang", "block", "other", "part"]
DIFFERENCES = "lang string, nth int, against int, value long, seen long"


def _tiles(sorted_rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of rows with one (lang, block, other, part), which may go over several batches."""
    for batch in sorted_rows:
        keys = list(zip(*(batch.column(c).to_pylist() for c in _TILE)))
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            yield keys[at], batch.slice(at, end - at)
            at = end


def _differences(size: int):
    """Differences of the sources of a block and another, added up over a slice of the terms.

    Rows of a tile come sorted by term, first those without a term: each source's number and the
    share of a term it does not hold.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, tile = None, None
        for key, rows in _tiles(batches):
            if key != open_key:
                if tile is not None:
                    yield tile.ended()
                open_key, tile = key, _Tile(key, size)
            tile.add(rows)
        if tile is not None:
            yield tile.ended()

    return run


class _Tile:
    def __init__(self, key: tuple, size: int):
        self.lang, self.block, self.other, _ = key
        self.size = size
        self.numbers: list[int] = []
        self.absent: list[int] = []
        self.seen, self.sums, self.table = 0, None, None

    def _start(self) -> None:
        self.order = np.argsort(self.numbers)
        self.sorted = np.array(self.numbers, np.int64)[self.order]
        self.none = np.array(self.absent, np.int64)
        blocks = np.array(self.numbers, np.int64) // self.size
        self.left, self.right = np.flatnonzero(blocks == self.block), np.flatnonzero(blocks == self.other)
        self.sums = np.zeros((len(self.left), len(self.right)), np.int64)
        self.table, self.used, self.term = np.tile(self.none, (ROWS, 1)), 0, None

    def _flush(self) -> None:
        left, right = self.table[: self.used, self.left], self.table[: self.used, self.right]
        for i in range(len(self.left)):
            self.sums[i] += np.abs(right - left[:, i : i + 1]).sum(axis=0)
        self.seen += self.used
        self.table[:], self.used = self.none, 0

    def add(self, rows: pa.RecordBatch) -> None:
        term, nth, p = rows.column("term").cast(pa.binary()), rows.column("nth").to_numpy(), rows.column("p").to_numpy()
        first = term.null_count
        self.numbers += nth[:first].tolist()
        self.absent += p[:first].tolist()
        if first == len(term):
            return
        if self.sums is None:
            self._start()
        term, nth, p = term.slice(first), nth[first:], p[first:]
        fresh = np.ones(len(term), bool)
        fresh[0] = term[0].as_py() != self.term
        fresh[1:] = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        line, at = np.cumsum(fresh) + (self.used - 1), self.order[np.searchsorted(self.sorted, nth)]
        while len(line):
            here = int(np.searchsorted(line, ROWS))
            self.table[line[:here], at[:here]] = p[:here]
            if here:
                self.used = int(line[here - 1]) + 1
            if here < len(line):
                self._flush()
            line, at, p = line[here:] - ROWS, at[here:], p[here:]
        self.term = term[len(term) - 1].as_py()

    def ended(self) -> pa.RecordBatch:
        if self.sums is None:
            self._start()
        self._flush()
        numbers = np.array(self.numbers, np.int32)
        shape = self.sums.shape
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.lang] * self.sums.size, pa.string()),
                pa.array(np.repeat(numbers[self.left], shape[1])),
                pa.array(np.tile(numbers[self.right], shape[0])),
                pa.array(self.sums.ravel()),
                pa.array(np.full(self.sums.size, self.seen, np.int64)),
            ],
            names=["lang", "nth", "against", "value", "seen"],
        )


def distances(kept: DataFrame, groups: DataFrame, size: int = BLOCK, laid: int = LAID) -> DataFrame:
    """lang, source, item, value, rank of each source against each other of its language."""
    of_lang = Window.partitionBy("lang")
    block = F.floor(F.col("nth") / size).cast("int")
    listed = groups.withColumn("own", block).withColumn("last", F.max(block).over(of_lang))
    none = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    # Each row of a language goes to as many tiles as it has blocks, of which two make one.
    parts = 1 + F.floor(2 * F.col("rows") / (F.lit(laid) * (F.col("last") + 2)))
    listed = keep(listed.withColumn("absent", F.coalesce(none, F.lit(0).cast("long"))).withColumn("parts", parts))
    # A source is in the pairs of blocks that hold its own, the lesser block first.
    pair = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("b")
    tile = [F.least("own", "b").alias("block"), F.greatest("own", "b").alias("other")]
    columns = ["lang", "block", "other", "part", "term", "nth", "p"]
    held = kept.join(small(listed), ["lang", "source"])
    held = held.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    held = held.select("*", pair).select("*", *tile, F.pmod(F.xxhash64("term"), F.col("parts")).alias("part")).select(columns)
    first = listed.select("*", pair).select("*", *tile, F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    first = first.withColumn("term", F.lit(None).cast("string")).withColumn("p", F.col("absent")).select(columns)
    dealt = held.unionByName(first).repartition(*_TILE).sortWithinPartitions(*_TILE, "term", "nth")
    sums = map_batches(dealt, _differences(size), DIFFERENCES).groupBy("lang", "nth", "against")
    sums = sums.agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))

    def side(number: str, prefix: str) -> DataFrame:
        return listed.select("lang", F.col("nth").alias(number), F.col("source").alias(f"{prefix}_source"), F.col("absent").alias(f"{prefix}_absent"), F.col("terms").alias(f"{prefix}_terms"))

    both = sums.filter(F.col("nth") < F.col("against")).join(small(side("nth", "a")), ["lang", "nth"]).join(small(side("against", "b")), ["lang", "against"])
    unseen = (F.col("a_terms") - F.col("seen")) * F.abs(F.col("a_absent") - F.col("b_absent"))
    value = (F.col("value") + unseen).alias("value")
    ways = F.array(*(F.struct(F.col(f"{x}_source").alias("source"), F.col(f"{y}_source").alias("item")) for x, y in ("ab", "ba")))
    each = both.select("lang", value, F.explode(ways).alias("way")).select("lang", "way.source", "way.item", "value")
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    return each.withColumn("rank", place)


def audit(docs: DataFrame, documents: int = DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank."""
    kept, groups = counts(docs, documents)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = distances(kept, groups).withColumn("part", F.lit("pair")).select(columns)
    return pairs.unionByName(favoured(kept, groups, top).withColumn("part", F.lit("term")).select(columns))
