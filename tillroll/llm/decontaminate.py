"""Benchmark passages in documents, by a positional inverted index of the rarest test terms.

Test items are cut into windows of ``WINDOW`` words; an item with fewer words is one window. The
documents are read twice. The first time, the occurrences of the test terms are counted, which says
which terms of a window are its rarest. The second time, postings (term, text, position) of the
``RAREST`` rarest terms of all windows are stored. The posting lists of a window are then intersected
from its rarest term on: a posting gives the place where the window would have to begin, and every
further list must hold its term at that place plus its own offset. What is left is compared with the
words around the first posting, which are kept with it.

The same lists tell where a window is paraphrased or cut up: a text holds it *nearly* if its two
rarest terms are at most ``WINDOW`` words apart there, in any order. Their postings meet by text and
stretch of the text, never all of a text with all.

Terms are counted and sought in lower case of all alphabets, which is at least as wide as that of A-Z
and cheap on whole texts; the comparison at the end takes A-Z alone.

Texts are named by a digest, so that equal texts have one set of postings, however many there are.
Test terms and windows are broadcast in slices of a bounded size, one after the other where the
benchmark has more. All of it is DataFrame functions.

Cases: null and empty texts, and texts without words, have no words and no hits; an item without
words has no window; equal windows of several items count for each of them; an item without id is
named ''; repeated documents get equal rows; an empty table of items gives no hits, an empty table
of documents no rows. Other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import fold_case, in_slices, joined, keep, n_terms, store, term_counts, terms

WINDOW = 10
RAREST = 2


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(phrase, words, item) of the windows of each item; phrase is the words joined by spaces."""
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), terms(fold_case(F.col("text"))).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - size + 1))
    cut = named.filter(F.size("all") > 0).withColumn("start", F.explode(starts))
    return (
        cut.withColumn("words", F.slice("all", F.col("start"), F.lit(size)))
        .select(F.array_join("words", " ").alias("phrase"), "words", "item")
        .distinct()
    )


def order_of_lists(phrases: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(phrase, size, step, term, offset): the terms by which a phrase is sought, rarest first.

    Phrases with a term that occurs nowhere are left out.
    """
    placed = phrases.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("offset", "word"))
    known = placed.withColumn("term", F.lower("word")).join(counts, "term")
    whole = known.groupBy("phrase").agg(F.count("*").alias("found"), F.first("size").alias("size"))
    possible = known.join(whole.filter("found = size").select("phrase"), "phrase", "left_semi")
    rarity = Window.partitionBy("phrase").orderBy("n", "term", "offset")
    ranked = possible.withColumn("step", F.row_number().over(rarity))
    return ranked.filter(F.col("step") <= rarest).select("phrase", "size", "step", "term", "offset")


def postings(docs: DataFrame, vocabulary: DataFrame, around: int = WINDOW - 1) -> DataFrame:
    """The index: (term, key, position, first, near), one row per occurrence in different texts.

    ``vocabulary`` has rows (term, leads). Where ``leads`` is set, ``near`` holds the words up to
    ``around`` places away, of which the first has position ``first``.
    """
    words = docs.filter("text IS NOT NULL").select(F.md5("text").alias("key"), terms(F.col("text")).alias("words"))
    placed = words.select("key", "words", F.posexplode("words").alias("position", "word")).withColumn("term", F.lower("word"))
    first = F.greatest(F.col("position") - around, F.lit(0))
    near = F.slice("words", first + 1, F.col("position") - first + 1 + around)
    parts = [
        placed.join(part, "term").select(
            "term", "key", "position", first.alias("first"), F.when(F.col("leads"), near).alias("near")
        )
        for part in in_slices(vocabulary, vocabulary.count())
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def phrase_matches(index: DataFrame, lists: DataFrame) -> DataFrame:
    """(phrase, key, start, size) of every exact occurrence, the lists intersected in their order."""
    leading = keep(lists.filter("step = 1").drop("step"))
    start = (F.col("position") - F.col("offset")).alias("start")
    found = joined(index.filter("near IS NOT NULL"), leading, "term", ["phrase", "size", "key", "position", "offset", "first", "near"])
    found = found.select("phrase", "size", "key", start, "first", "near").filter("start >= 0")
    for step in range(2, RAREST + 1):
        more = keep(lists.filter(F.col("step") == step).select("phrase", "term", "offset"))
        columns = [*found.columns, "term", "offset"]
        asked = joined(found, more, "phrase", columns).withColumn("position", F.col("start") + F.col("offset"))
        passed = asked.join(index.select("term", "key", "position"), ["term", "key", "position"], "left_semi")
        shorter = found.filter(F.col("size") < step)
        found = passed.select(found.columns).unionByName(shorter)
    here = F.slice("near", F.col("start") - F.col("first") + 1, F.col("size"))
    return found.filter(fold_case(F.array_join(here, " ")) == F.col("phrase")).select("phrase", "key", "start", "size")


def proximity_matches(index: DataFrame, one: str, other: str, within: int) -> DataFrame:
    """(key, position, other_position) where two indexed terms are at most ``within`` words apart.

    Postings meet by text and stretch of the text, never all of a text with all.
    """
    stretch = F.floor(F.col("position") / within)
    left = index.filter(F.col("term") == one).select("key", "position", stretch.alias("__s"))
    right = index.filter(F.col("term") == other).select(
        "key",
        F.col("position").alias("other_position"),
        F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("__s"),
    )
    apart = F.abs(F.col("position") - F.col("other_position"))
    return left.join(right, ["key", "__s"]).filter((apart <= within) & (apart > 0 if one == other else F.lit(True))).drop("__s")


def near_windows(index: DataFrame, lists: DataFrame, within: int = WINDOW) -> DataFrame:
    """(key, phrase) of texts in which the rarest two terms of a phrase, or its one, stand at most
    ``within`` words apart, whatever is between them and in either order."""
    one = keep(lists.filter("step = 1").select("phrase", "term"))
    two = keep(lists.filter("step = 2").select("phrase", F.col("term").alias("other")))
    leads = index.filter("near IS NOT NULL").select("term", "key", "position")
    found = joined(leads, one, "term", ["phrase", "key", "position"])
    asked = joined(found, two, "phrase", ["phrase", "key", "position", "other"])
    stretch = F.floor(F.col("position") / within)
    left = asked.select("phrase", "key", F.col("other").alias("term"), F.col("position").alias("from"), stretch.alias("stretch"))
    around = F.explode(F.array(stretch - 1, stretch, stretch + 1)).alias("stretch")
    right = index.select("term", "key", "position", around)
    apart = F.abs(F.col("from") - F.col("position"))
    near = left.join(right, ["term", "key", "stretch"]).filter((apart > 0) & (apart <= within)).select("key", "phrase")
    alone = one.join(two, "phrase", "left_anti").select("phrase", "term")
    return near.unionByName(joined(leads, keep(alone), "term", ["key", "phrase"])).distinct()


def searched(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index of the terms by which windows are sought, their lists, and the windows (phrase, words, item)."""
    cut = keep(windows(items))
    phrases = cut.select("phrase", "words").distinct()
    vocabulary = keep(phrases.select(F.explode("words").alias("word")).select(F.lower("word").alias("term")).distinct())
    lists = keep(order_of_lists(phrases, term_counts(docs, vocabulary)))
    sought = keep(lists.groupBy("term").agg(F.max(F.col("step") == 1).alias("leads")))
    return store(postings(docs, sought), "postings"), lists, cut


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(phrase, key, start, size) of all occurrences."""
    index, lists, _ = searched(docs, items)
    return phrase_matches(index, lists)


def hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, n_near, n_hit, n_items, items_sha256) of every text with a phrase or its rarest terms near."""
    index, lists, cut = searched(docs, items)
    near = near_windows(index, lists).groupBy("key").agg(F.count("*").alias("n_near"))
    found = keep(phrase_matches(index, lists))
    end = F.col("start") + F.col("size")
    ordered = Window.partitionBy("key").orderBy("start", "size")
    reached = F.coalesce(F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("start"), reached))
    covered = found.select("key", fresh.alias("n")).groupBy("key").agg(F.sum("n").cast("long").alias("n_hit"))
    of = joined(found.select("key", "phrase").distinct(), cut.select("phrase", "item"), "phrase", ["key", "item"])
    named = of.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return near.join(covered.join(named, "key"), "key", "full").select(
        "key",
        "n_near",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, n_near (windows held nearly), contaminated."""
    found = hits(docs.select("text"), items)
    rows = docs.select("doc_id", F.md5("text").alias("key"), n_terms(F.col("text")).alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(found, "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.when(n_hit > 0, F.col("n_items")).otherwise(0).cast("long").alias("n_items"),
        F.coalesce(F.when(n_hit > 0, F.col("items_sha256")), F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        (n_hit > 0).alias("contaminated"),
    )


def without_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with the columns they came with."""
    found = matches(docs.select("text"), items)
    keys = keep(found.select(F.col("key").alias("__hit")).distinct())
    kept = docs
    for part in in_slices(keys, keys.count()):
        kept = kept.join(part, F.md5("text") == F.col("__hit"), "left_anti")
    return kept
