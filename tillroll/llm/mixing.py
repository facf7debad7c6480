"""Mixing sources to target weights: floor(rate) copies of a document and one Bernoulli copy more.

Words are summed per source, each source is given a target, and ``rate = target / size`` of its
source says how often a document is emitted: floor(rate) times, and once more with probability
``rate - floor(rate)`` by a hash of a seed, the id and the text. The draw needs no other row, so a
hot source is spread as the input is, and a rerun draws the same. Sums of independent draws stray
from their target; so each source takes, of ``SEEDS`` seeds, the one whose sum comes nearest.

Cases: a null text has no words and is drawn like any other; null sources are one source, last in
order; a source without words has target 0 and gives nothing; rows that repeat an id and a text
draw alike; an empty table gives an empty mix. Columns other than the three named are carried and
may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import WORD, keep, small

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = 17
SEEDS = 16

_SOURCE, _WORDS, _TARGET, _TOTAL, _COPY, _KNOWN, _SEED = (
    "__mix_source", "__mix_words", "__mix_target", "__mix_total", "__mix_copy", "__mix_known", "__mix_seed",
)
#: Digits of a hash that make one draw, of the 32 there are.
_DIGITS = 8


def words(text: Column) -> Column:
    """Number of words in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def known_by(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A digest of the seed, the id and the text."""
    parts = (F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.md5(text), F.lit("")))
    return F.md5(F.concat(*parts))


def draw(known: Column, seed: Column) -> Column:
    """A number in [0, 1) from a digest, for seeds from 0 up."""
    each = 32 // _DIGITS
    digits = F.md5(F.concat(known, F.lit(":"), F.floor(seed / each).cast("string")))
    drawn = F.substring(digits, (seed % each * _DIGITS + 1).cast("int"), F.lit(_DIGITS))
    return F.conv(drawn, 16, 10).cast("long") / F.lit(float(16**_DIGITS))


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Targets of a table with one row per source: its name and words.

    Sources in code point order, null last, take the weights in turn. All targets sum to all words.
    A target stops at ``cap`` times its source, and what is over goes to the others by weight, until
    none is above: with sources sorted by size per weight, those before some point are at their cap
    and the rest share what is left. The window is over sources, not documents.
    """
    turn = (F.row_number().over(Window.orderBy(F.col(_SOURCE).asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    tight = Window.orderBy(F.col(_TOTAL) / F.col("__w"), F.col(_SOURCE).asc_nulls_last())
    before, after = tight.rowsBetween(Window.unboundedPreceding, -1), tight.rowsBetween(0, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("__w", weight)
        .withColumn("__before", F.coalesce(F.sum(_TOTAL).over(before), F.lit(0)))
        .withColumn("__after", F.sum(_TOTAL).over(after))
        .withColumn("__shares", F.sum("__w").over(after))
        .withColumn("__left", F.col("__before") + F.col("__after") - cap * F.col("__before"))
        .withColumn("__capped", F.col("__w") * F.col("__left") >= cap * F.col(_TOTAL) * F.col("__shares"))
    )
    first = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_at = F.min(F.when(~F.col("__capped"), F.struct((F.col(_TOTAL) / F.col("__w")).alias("r"), F.col("__left").alias("left"), F.col("__shares").alias("shares")))).over(first)
    return ranked.withColumn("__open", open_at).select(
        _SOURCE,
        _TOTAL,
        F.when(F.col("__capped") | F.col("__open").isNull(), (cap * F.col(_TOTAL)).cast("double"))
        .otherwise((F.col("__w") * F.col("__open.left")).cast("double") / F.col("__open.shares"))
        .alias(_TARGET),
    )


def rate_of(target: Column, total: Column) -> Column:
    return F.when(total > 0, target / total).otherwise(0.0)


def with_seeds(digests: DataFrame, targets: DataFrame, seeds: int = SEEDS) -> DataFrame:
    """The targets with the seed of each source, from rows (source, words, digest)."""
    rate = rate_of(F.col(_TARGET), F.col(_TOTAL))
    extra = rate - F.floor(rate)
    placed = digests.join(small(targets), F.col("source").eqNullSafe(F.col(_SOURCE)))
    sums = [
        F.sum(F.when(draw(F.col(_KNOWN), F.lit(k)) < extra, F.col(_WORDS)).otherwise(0)).alias(f"__{k}") for k in range(seeds)
    ]
    drawn = placed.groupBy(_SOURCE, _TOTAL, _TARGET).agg(*sums)
    off = [F.struct(F.abs(F.floor(rate) * F.col(_TOTAL) + F.col(f"__{k}") - F.col(_TARGET)).alias("off"), F.lit(k).alias("k")) for k in range(seeds)]
    return drawn.select(_SOURCE, _TOTAL, _TARGET, F.array_min(F.array(*off))["k"].alias(_SEED))


def digested(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, source, words and digest of every document."""
    return docs.select(
        "doc_id", "source", words(F.col("text")).alias(_WORDS), known_by(F.col("doc_id"), F.col("text"), seed).alias(_KNOWN)
    )


def plan(digests: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per source: its words, target and seed."""
    sizes = digests.groupBy(F.col("source").alias(_SOURCE)).agg(F.sum(_WORDS).alias(_TOTAL))
    return keep(with_seeds(digests, keep(source_targets(sizes, weights, cap))))


def copied(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Rows with source, words and digest, and how often each is emitted."""
    rate = rate_of(F.col(_TARGET), F.col(_TOTAL))
    extra = (draw(F.col(_KNOWN), F.col(_SEED)) < rate - F.floor(rate)).cast("long")
    placed = rows.join(small(plans), F.col("source").eqNullSafe(F.col(_SOURCE)))
    return placed.withColumn(_COPY, F.floor(rate) + extra)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mixed corpus: each document as often as planned, with the columns it came with."""
    plans = plan(keep(digested(docs, seed)), weights, cap)
    known = docs.withColumn(_KNOWN, known_by(F.col("doc_id"), F.col("text"), seed))
    taken = copied(known, plans).filter(F.col(_COPY) > 0)
    return taken.withColumn(_COPY, F.explode(F.sequence(F.lit(1).cast("long"), F.col(_COPY)))).select(docs.columns)


def report(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """One row per document: its words, its source's words and target, and the words taken."""
    digests = keep(digested(docs, seed))
    return copied(digests, plan(digests, weights, cap)).select(
        "doc_id",
        F.col(_WORDS).alias("size"),
        F.col(_TOTAL).alias("source_size"),
        F.col(_TARGET).alias("target"),
        (F.col(_WORDS) * F.col(_COPY)).alias("taken"),
    )
