"""URL verdicts: rules of hosts and paths, and a ratio of character models where no rule fits.

The urls that a rule decides train one smoothed variable-order Markov model for accepted and one
for rejected urls: bytes given the up to ``ORDER - 1`` before them, each order falling back on the
one below by the number of different successors it has seen (Witten and Bell). A url that no rule
decides is judged by the difference of its two log-likelihoods per byte. The threshold is set where
the two shares of wrong verdicts together are least, on a tenth of the decided urls, chosen by
hash, that the models have not seen.

Counts are summed by Spark over all decided urls, and are exact. They grow with the urls: tasks hold
them in slices of a bounded size (``grams``), each of which gives its part of every url's score.

Cases: a null url, or one without '://', has an empty host and path, fits no rule, and is judged by
its whole text; an empty one has nothing to judge by and is allowed; without decided urls of both
kinds all others are allowed; equal urls get equal verdicts; an empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.base import fold_case, store
from tillroll.llm.grams import BITS, SLICE, Table, in_slice, ours, slice_numbers, table_of
from tillroll.llm.kernels import chunks, rows_of

#: (host, path, verdict); fixed values.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
ORDER = 5
BINS = 1 << 10
#: Differences per byte beyond this many nats are put in the outermost bins of the calibration.
SPAN = 8.0

def parts(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path of a url."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return (
        fold_case(F.regexp_extract(rest, r"^[^/?#]*", 0)),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    )


def decided(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, url, host, path, and rule and verdict of the longest rule that fits, else null."""
    host, path = parts(F.col("url"))
    split = pages.select("page_id", F.col("url").cast("string"), host.alias("host"), path.alias("path"))
    rule = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return split.withColumn("rule", rule).withColumn("verdict", verdict)


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each byte with its context as one number, from the shortest context up, and which have one.

    Before the first byte stands one mark; a longer context than there is is that of the order below.
    """
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    gram = data.astype(np.int64) + 1
    for back in range(ORDER):
        if back:
            before = np.full(len(data), _START + 1, np.int64)
            before[back:] = np.where(place[back:] >= back, data[: len(data) - back].astype(np.int64) + 1, _START + 1)
            gram = gram | np.where(place >= back - 1, before, 0) << (BITS * back)
        yield gram, place >= back - 1


_START = 256


@dataclass
class Model:
    """A slice of the counts of both classes: grams, and contexts with their sums and successors."""

    grams: Table  # by kind
    contexts: Table  # sums by kind, then successors by kind
    nth: int
    numbers: Table | None

    def differences(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """What the slice adds to the log-likelihood of each text as accepted less that as rejected."""
        p = np.full((2, len(data)), 1 / 256)
        for gram, there in grams(data, offsets):
            counts, context = self.grams[gram], self.contexts[gram >> BITS]
            for kind in (0, 1):
                seen, kinds = context[:, kind], context[:, 2 + kind]
                p[kind] = np.where(there & (seen > 0), (counts[:, kind] + kinds * p[kind]) / np.maximum(seen + kinds, 1), p[kind])
        own = ours(gram >> BITS, self.nth, self.numbers)
        return np.bincount(rows_of(offsets)[own], np.log(p[1][own] / p[0][own]), len(offsets) - 1)


def count_grams(urls: DataFrame) -> DataFrame:
    """(gram, n0, n1) of all rows (kind, url), summed over the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in chunks(batch.column(1)):
                kind = kinds[lo:hi][rows_of(offsets)]
                for gram, there in grams(data, offsets):
                    for k in (0, 1):
                        own, n = np.unique(gram[there & (kind == k)], return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.full(len(own), k, np.int32)), pa.array(n)], ["gram", "kind", "n"])

    counted = urls.mapInArrow(run, "gram long, kind int, n long")
    return counted.groupBy("gram").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)))


def fit(urls: DataFrame, size: int = SLICE) -> tuple[list[Model], bool]:
    """The models of rows (kind, url) slice by slice, and whether there are urls of both kinds."""
    counts = store(count_grams(urls), "url-grams").withColumn("context", F.shiftright("gram", BITS))
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in (0, 1)]
    kinds = [F.count_if(F.col(f"n{k}") > 0).alias(f"kinds{k}") for k in (0, 1)]
    contexts = counts.groupBy("context").agg(*sums, *kinds)
    rows, *both = counts.agg(F.count("*"), F.sum("n0"), F.sum("n1")).first()
    n = 1 + rows // size
    numbers = slice_numbers(urls.sparkSession, n)
    models = []
    for i in range(n):
        held = counts.filter(in_slice(F.col("context"), i, n)).drop("context"), contexts.filter(in_slice(F.col("context"), i, n))
        models.append(Model(table_of(held[0], "gram"), table_of(held[1], "context"), i, numbers))
    return models, bool(both[0] and both[1])


def differences(frame: DataFrame, models: list[Model]) -> DataFrame:
    """Adds ``score``: log-likelihood of a byte of ``url`` as accepted less that as rejected."""
    at = frame.columns.index("url")

    def step(frame: DataFrame, model: Model, last: bool) -> DataFrame:
        sent, started = frame.sparkSession.sparkContext.broadcast(model), "score" in frame.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                score = batch.column(batch.num_columns - 1).to_numpy().copy() if started else np.zeros(batch.num_rows)
                for lo, hi, data, offsets in chunks(batch.column(at)):
                    score[lo:hi] += sent.value.differences(data, offsets)
                    if last:
                        score[lo:hi] /= np.maximum(np.diff(offsets), 1)
                own = batch.columns[:-1] if started else batch.columns
                names = batch.schema.names[:-1] if started else batch.schema.names
                yield pa.RecordBatch.from_arrays([*own, pa.array(score)], [*names, "score"])

        fields = [f for f in frame.schema.fields if not (started and f.name == "score")]
        return frame.mapInArrow(run, T.StructType([*fields, T.StructField("score", T.DoubleType())]))

    for i, model in enumerate(models):
        last = i == len(models) - 1
        frame = step(frame, model, last)
        frame = frame if last else store(frame, "url-scores")
    return frame


def threshold(scored: DataFrame) -> float:
    """Where the shares of wrong verdicts on rows (kind, score) sum to the least; 0 without rows."""
    bin_of = F.floor((F.col("score") + SPAN) / (2 * SPAN) * BINS)
    found = scored.groupBy("kind", F.greatest(F.lit(0), F.least(F.lit(BINS - 1), bin_of)).alias("bin")).count().toArrow()
    counts = np.zeros((2, BINS))
    counts[found["kind"], found["bin"]] = found["count"]
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(shares, axis=1)], axis=1)
    wrong = below[1] + shares[0].sum() - below[0]
    least = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    nearest = least[np.argmin(np.abs(least - BINS // 2))]  # of equal ones the nearest to no difference
    return float(nearest / BINS * 2 * SPAN - SPAN)


def verdicts(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every page."""
    urls = decided(pages, rules)
    kind = (F.col("verdict") == "allow").cast("int").alias("kind")
    ruled = urls.filter(F.col("rule").isNotNull()).select(kind, "url")
    held_out = F.pmod(F.crc32("url"), F.lit(10)) == 0
    models, both = fit(ruled.filter(~held_out))
    if not both:
        return urls.withColumn("verdict", F.coalesce("verdict", F.lit("allow"))).withColumn("score", F.lit(0.0)).drop("url")
    least = threshold(differences(ruled.filter(held_out), models))
    judged = F.when((F.coalesce(F.length("url"), F.lit(0)) == 0) | (F.col("score") >= least), "allow").otherwise("block")
    return (
        differences(urls, models)
        .withColumn("verdict", F.coalesce("verdict", judged))
        .select("page_id", "host", "path", "rule", "verdict", "score")
    )
