"""Repeated runs of ``LENGTH`` bytes across a corpus, by merged Burrows-Wheeler transforms.

A byte goes if a run of LENGTH bytes that covers it also begins earlier: in a document with a
smaller id, or before in the same one. Where a text is the same as one with a smaller id, all of it
goes (if it has a run at all). In the other texts, each run is represented by its anchor, the least
hash of ``ANCHOR`` bytes in it, so that equal runs have equal anchors. Runs in a row with one anchor
are a span. Spans travel as two hashes and their place, and meet by anchor:

- of equal spans all but the first are repeats;
- an anchor with one span is done with;
- different spans with one anchor may have some runs in common. Those that also agree in ``SIDE``
  bytes beside the anchor, as spans with a common run must, are read from the texts and put in
  shards. The shards' transforms are merged (``bwt``), and the blocks of suffixes with a common
  prefix of LENGTH bytes say which runs begin earlier.

Spans of one anchor are compared in one task as long as they are at most ``GROUP``. Of larger groups
each run is looked up by its own hash, which spreads them over all tasks.

Cases: null and empty texts and those of less than LENGTH bytes lose nothing; rows that repeat an id
and a text are one document and get equal results; different texts with one id are ordered by a hash
of the text; null ids come first; long texts are read whole; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm import bwt
from tillroll.llm.base import keep, map_batches, small, store
from tillroll.llm.kernels import ByteHash, chunks, rows_of

LENGTH = 100
ANCHOR = 24
SIDE = (LENGTH - ANCHOR) // 2
GROUP = 8192
SHARDS = 4
#: Bytes whose transforms are merged at once, if they are of several anchors.
BATCH = 1 << 16

_PLACE_BITS = np.uint64(24)


def least_anchor(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least hash in each window, the first of equal ones."""
    low = np.uint64((1 << int(_PLACE_BITS)) - 1)
    marked = (hashes & ~low) | (np.arange(len(hashes), dtype=np.uint64) & low)
    pad = -len(marked) % window
    blocks = np.concatenate([marked, np.full(pad, ~np.uint64(0))]).reshape(-1, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(hashes) - window + 1
    least = np.minimum(behind[:n], ahead[window - 1 : window - 1 + n])
    begin = np.arange(n)
    # The low bits of a place and the window it is in give the place.
    return begin + ((least & low).astype(np.int64) - begin) % (1 << int(_PLACE_BITS))


def spans_of(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The spans of some texts: row, start, length, and hashes of anchor, span and both sides."""
    names = ("row", "start", "length", "anchor", "span", "left", "right")
    if len(data) < LENGTH:
        return {name: np.zeros(0, np.int64) for name in names}
    part = ByteHash(data)
    keys = part(np.arange(len(data) - ANCHOR + 1), np.arange(ANCHOR, len(data) + 1))
    anchors = least_anchor(keys, LENGTH - ANCHOR + 1)
    row = rows_of(offsets)[: len(anchors)]
    begin = np.flatnonzero(np.arange(len(anchors)) + LENGTH <= offsets[1:][row])
    if not len(begin):
        return {name: np.zeros(0, np.int64) for name in names}
    at = anchors[begin]
    new = np.ones(len(begin), bool)
    new[1:] = (at[1:] != at[:-1]) | (begin[1:] != begin[:-1] + 1)
    start, at = begin[new], at[new]
    end = begin[np.append(np.flatnonzero(new)[1:], len(begin)) - 1] + LENGTH

    def side(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """16 bits of the hash of a side, 0 where the span does not hold it."""
        inside = (lo >= start) & (hi <= end)
        out = np.zeros(len(start), np.int64)
        out[inside] = (part(lo[inside], hi[inside]) >> np.uint64(48)).astype(np.int64) | 1
        return out

    return {
        "row": row[start],
        "start": start - offsets[:-1][row[start]],
        "length": end - start,
        "anchor": keys[at].view(np.int64),
        "span": part(start, end).view(np.int64),
        "left": side(at - SIDE, at),
        "right": side(at + ANCHOR, at + ANCHOR + SIDE),
    }


SPANS = "anchor long, span long, doc long, tie long, start long, packed long"


def spans(docs: DataFrame) -> DataFrame:
    """Spans of rows (doc, tie, text); ``packed`` holds length, left and right."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tie = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offsets in chunks(batch.column(2)):
                s = spans_of(data, offsets)
                packed = s["length"] << 32 | s["left"] << 16 | s["right"]
                columns = [s["anchor"], s["span"], doc[lo:hi][s["row"]], tie[lo:hi][s["row"]], s["start"], packed]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f.split()[0] for f in SPANS.split(", ")])

    return map_batches(docs.select("doc", "tie", "text"), run, SPANS)


def met(found: DataFrame) -> DataFrame:
    """The spans that are not the only one of their anchor, with ``again``.

    ``again`` is set on all but the first of equal spans; of the others, only those that share their
    anchor with a different span are returned. Spans stream by in order, and only the first of the
    span at hand is kept.
    """
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [*found.columns, "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, given = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            c = np.stack([batch.column(i).to_numpy() for i in range(6)])
            if held is not None:
                c = np.concatenate([held[:, None], c], axis=1)
            new_anchor = np.ones(c.shape[1], bool)
            new_anchor[1:] = c[0, 1:] != c[0, :-1]
            new_span = new_anchor.copy()
            new_span[1:] |= c[1, 1:] != c[1, :-1]
            first = np.maximum.accumulate(np.where(new_span, np.arange(c.shape[1]), 0))
            again = (c[2:5] != c[2:5, first]).any(0)  # a row given twice is at the place of the first
            group = np.cumsum(new_anchor) - 1
            several = np.bincount(group, new_span)[group] > 1
            if given:
                several |= group == 0
            out = again | new_span & several
            out[0] &= not given
            yield pa.RecordBatch.from_arrays([*map(pa.array, c[:, out]), pa.array(again[out])], names)
            held, given = c[:, first[-1]], bool(several[-1])

    ordered = found.repartition(tasks, "anchor").sortWithinPartitions("anchor", "span", "doc", "tie", "start")
    return ordered.mapInArrow(run, SPANS + ", again boolean")


def alike(edges: DataFrame) -> DataFrame:
    """(anchor, doc, tie, start, length) of spans that agree with another beside the anchor too."""
    packed = F.col("packed")
    sides = F.array(
        F.struct(F.lit("l").alias("side"), F.shiftright(packed, 16).bitwiseAND(F.lit(0xFFFF)).alias("value")),
        F.struct(F.lit("r").alias("side"), packed.bitwiseAND(F.lit(0xFFFF)).alias("value")),
    )
    length = F.shiftright(packed, 32).alias("length")
    sided = edges.select("anchor", "doc", "tie", "start", length, F.explode(sides).alias("s"))
    sided = sided.select("anchor", "doc", "tie", "start", "length", "s.side", "s.value").filter("value != 0")
    shared = sided.groupBy("anchor", "side", "value").agg(F.count("*").alias("n")).filter("n > 1")
    of = ["anchor", "side", "value"]
    return sided.join(shared, of, "left_semi").select("anchor", "doc", "tie", "start", "length").distinct()


def strings(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(anchor, doc, tie, start, string) of the spans asked for, from rows (doc, tie, text)."""
    per_doc = asked.groupBy("doc", "tie").agg(F.collect_list(F.struct("anchor", "start", "length")).alias("spans"))
    wanted = docs.join(per_text(keep(per_doc), F.size("spans") * 24), ["doc", "tie"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py().encode()
                cut = batch.column(3)[i].values
                anchor, start, length = (cut.field(k) for k in range(3))
                n = len(anchor)
                pieces = [text[a : a + b] for a, b in zip(start.to_pylist(), length.to_pylist())]
                doc, tie = (pa.array([batch.column(k)[i].as_py()] * n, pa.int64()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [anchor, doc, tie, start, pa.array(pieces, pa.binary())], ["anchor", "doc", "tie", "start", "string"]
                )

    asked = wanted.select("doc", "tie", "text", "spans")
    return map_batches(asked, run, "anchor long, doc long, tie long, start long, string binary")


def per_text(frame: DataFrame, bytes_of: Column) -> DataFrame:
    """A kept frame with one row per text, broadcast if it is known to be small."""
    rows, size = frame.agg(F.count("*"), F.sum(bytes_of)).first()
    return small(frame, rows) if (size or 0) <= 32 << 20 else frame


def letters_of(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return ByteHash(data)(starts, starts + bwt.LETTER)


def merged_runs(found: DataFrame) -> DataFrame:
    """(doc, tie, start, end) covered by runs that begin earlier, from rows of ``strings``."""
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
        doc, tie, start = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3))
        which, place = bwt.repeated([r[4] for r in rows], doc % SHARDS, LENGTH, letters_of)
        new = np.ones(len(which), bool)
        new[1:] = (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(which))[: len(first)] - 1
        of = which[first]
        begin, end = start[of] + place[first], start[of] + place[last] + LENGTH
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (doc[of], tie[of], begin, end)], ["doc", "tie", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if rows and row[0] != rows[-1][0] and size >= BATCH:
                    yield compared(rows)
                    rows, size = [], 0
                if not rows or row[:4] != rows[-1][:4]:
                    rows.append(row)
                    size += len(row[4])
        if rows:
            yield compared(rows)

    ordered = found.repartition(tasks, "anchor").sortWithinPartitions("anchor", "doc", "tie", "start")
    return ordered.mapInArrow(run, "doc long, tie long, start long, end long")


def single_runs(found: DataFrame) -> DataFrame:
    """Every run of rows of ``strings`` as a span of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = np.frombuffer(batch.column(4)[i].as_py(), np.uint8)
                at = np.arange(len(data) - LENGTH + 1)
                part, ones = ByteHash(data), np.ones(len(at), np.int64)
                doc, tie, start = (batch.column(k)[i].as_py() for k in (1, 2, 3))
                columns = [
                    part(at, at + LENGTH // 2).view(np.int64),
                    part(at, at + LENGTH).view(np.int64),
                    *(ones * doc, ones * tie, start + at, ones * LENGTH << 32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], [f.split()[0] for f in SPANS.split(", ")])

    return found.mapInArrow(run, SPANS)


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, tie, start, end) covered by runs that begin earlier, from rows (doc, tie, text)."""
    found = store(met(spans(docs)), "spans")
    whole = ["doc", "tie", "start", (F.col("start") + F.shiftright("packed", 32)).alias("end")]
    edges = store(alike(found.filter("NOT again")), "edges")
    crowded = keep(edges.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP).select("anchor"))
    crowded = small(crowded)
    read = strings(docs, edges.join(crowded, "anchor", "left_anti"))
    rest = strings(docs, edges.join(crowded, "anchor", "left_semi"))
    return (
        found.filter("again").select(whole)
        .unionByName(merged_runs(read))
        .unionByName(met(single_runs(rest)).filter("again").select(whole))
    )


def covers(found: DataFrame) -> DataFrame:
    """(doc, tie, cover): the stretches of each document, joined where they touch, as 64-bit pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for stretches in batch.column(2):
                start, end = (stretches.values.field(k).to_numpy() for k in (0, 1))
                reach = np.maximum.accumulate(end)
                new = np.ones(len(start), bool)
                new[1:] = start[1:] > reach[:-1]
                first = np.flatnonzero(new)
                out.append(np.stack([start[first], reach[np.append(first[1:], len(start)) - 1]], axis=1).tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())], ["doc", "tie", "cover"])

    listed = found.groupBy("doc", "tie").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("all"))
    return listed.mapInArrow(run, "doc long, tie long, cover binary")


def placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, doc, tie, key, text), and (doc, key) of those whose text an earlier one has."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    rows = docs.select(F.col("doc_id").cast("long"), doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.md5("text"))
    ids = keep(rows.select("doc", "key").distinct())
    several = ids.groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1").select("doc", F.lit(True).alias("__several"))
    copies = ids.join(ids.groupBy("key").agg(F.min("doc").alias("__least")), "key").filter("doc > __least")
    tied = rows.join(small(keep(several)), "doc", "left")
    tie = F.when(F.col("__several"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))
    return tied.withColumn("tie", tie).drop("__several"), keep(copies.select("doc", "key"))


def covered(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, cover) with a null cover where nothing goes."""
    rows, copies = placed(docs)
    copies = small(copies)
    distinct_texts = rows.join(copies, ["doc", "key"], "left_anti").select("doc", "tie", "text")
    found = store(covers(repeats(distinct_texts)), "covers")
    copied = copies.withColumn("copied", F.lit(True))
    return (
        rows.join(per_text(found, F.length("cover") + 16), ["doc", "tie"], "left")
        .join(copied, ["doc", "key"], "left")
        .select("doc_id", "text", "cover", F.coalesce("copied", F.lit(False)).alias("copied"))
    )


def stretches_of(text: bytes, cover: bytes | None, copied: bool) -> np.ndarray:
    if copied:
        return np.array([[0, len(text)]] if len(text) >= LENGTH else [], np.int64).reshape(-1, 2)
    return np.frombuffer(cover or b"", np.int64).reshape(-1, 2)


def left_over(text: bytes, stretches: np.ndarray) -> bytes:
    edges = [0, *stretches.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


REPORT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def report(docs: DataFrame) -> DataFrame:
    """One row per document: bytes, bytes and stretches that go, and a digest of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, cover, copied in zip(*(batch.column(i) for i in (1, 2, 3))):
                text = text.as_py().encode()
                gone = stretches_of(text, cover.as_py(), copied.as_py())
                rest = left_over(text, gone)
                rows.append((len(text), len(text) - len(rest), len(gone), hashlib.sha256(rest).hexdigest()))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array([r[3] for r in rows], pa.string())], [f.split()[0] for f in REPORT.split(", ")]
            )

    return map_batches(covered(docs), run, REPORT)


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id and what is left of each text, as bytes: a cut may fall inside a character."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for text, cover, copied in zip(*(batch.column(i) for i in (1, 2, 3))):
                text = text.as_py().encode()
                left.append(left_over(text, stretches_of(text, cover.as_py(), copied.as_py())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.binary())], ["doc_id", "kept"])

    return map_batches(covered(docs), run, "doc_id long, kept binary")
