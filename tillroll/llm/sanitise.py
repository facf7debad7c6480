"""Personal data in texts, and the terms that give it away.

Emails, IP addresses, card and phone numbers are found by pattern. Which other terms reveal them is
estimated from the corpus: with N terms in all, n(k) of them within ``CONTEXT`` characters of an
entity of kind k, n(t) occurrences of a term and n(t, k) of these so near, the pointwise mutual
information is ``PMI = log2(N n(t, k) / (n(t) n(k)))`` and what there is to disclose is
``IC = log2(N / n(k))``. A term whose ``PMI / IC`` reaches ``REMOVE`` is removed beside entities of
the kind, one that reaches ``GENERALISE`` is replaced by a mark. These estimates count all documents,
copies included; a term needs ``SUPPORT`` different texts in which it stands beside one, so copies
of one text do not make its words telling.

The same is asked of each entity by itself, over whole texts: of D documents, n(e) hold the entity,
n(t) the term and n(t, e) both, ``PMI = log2(D n(t, e) / (n(t) n(e)))``, ``IC = log2(D / n(e))``, and
at least ``SUPPORT`` different texts hold both. Such a term gives the entity away wherever it stands,
so all its occurrences are taken, in texts without the entity too. Emails are one entity in any case
of letters, cards and phone numbers in any spacing.

Texts are named by a digest of 16 bytes, so that equal texts are searched for spans as one. The terms
of whole texts are listed for texts that hold an entity often enough; from these come the terms that
could reach a threshold. Those, and the terms beside entities, are counted in the corpus, where each
task sends one row a term; only texts that hold a term found to be telling are looked up. Where it
stands is counted along the words of each text, without a shuffle. All of it is DataFrame functions.

Cases: a null text is an empty one and has no spans; offsets are code points, ends exclusive; a term
that is telling for several kinds counts once, removal before replacement; terms that overlap an
entity are part of it; repeated documents get equal rows; an empty table gives no rows. Other
columns are not read, and ``sanitised`` carries them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import TERM, joined, keep, n_terms, small, store, term_counts, terms

CONTEXT = 80
GENERALISE = 0.75
REMOVE = 0.9
SUPPORT = 3

#: By kind, in order. A run of the first class is entered at its beginning, or where the match
#: before it ended, so that no run is tried from each of its characters.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "term")
#: Of at least one digit; what is left after leading zeros may be nothing.
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}+)?+"


def digest(text: Column) -> Column:
    """The name of a text."""
    return F.unhex(F.md5(text))


def luhn(digits: Column) -> Column:
    """Whether the check digit of a run of digits is right."""
    turned = F.reverse(digits)

    def added(total: Column, i: Column) -> Column:
        digit = turned.substr(i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), added) % 10 == 0


def valid(kind: Column, hit: Column) -> Column:
    """Whether a match is kept."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == "ip", hit.rlike(rf"^(?:{_BYTE}\.){{3}}{_BYTE}$"))
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def matches(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end, hit, before, after, goes_on, runs_into, copies) of valid matches in different
    texts; whether the match before ends, and the next one begins, within what may be a word."""
    frame = docs.filter("text IS NOT NULL").select(digest(F.col("text")).alias("key"), "text")
    for kind, pattern in PATTERNS.items():
        frame = frame.withColumn(f"hits_{kind}", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    frame = frame.filter(" OR ".join(f"size(hits_{kind}) > 0" for kind in PATTERNS))
    for kind, pattern in PATTERNS.items():
        some = F.size(f"hits_{kind}") > 0
        frame = frame.withColumn(f"gaps_{kind}", F.when(some, F.split("text", pattern, -1)))

    def found(kind: str) -> Column:
        hits, gaps = F.col(f"hits_{kind}"), F.col(f"gaps_{kind}")

        def one(hit: Column, i: Column) -> Column:
            gap, rest = F.get(gaps, i), F.get(gaps, i + 1)
            return F.struct(
                F.lit(kind).alias("kind"),
                i.alias("nth"),
                F.length(gap).alias("gap"),
                hit.alias("hit"),
                # One character more than the context tells whether its first word is whole.
                F.right(gap, F.lit(CONTEXT + 1)).alias("before"),
                F.left(rest, F.lit(CONTEXT + 1)).alias("after"),
                F.coalesce(F.get(hits, i - 1).rlike(f"{TERM}\\z"), F.lit(False)).alias("goes_on"),
                F.coalesce(F.get(hits, i + 1).rlike(f"^{TERM}"), F.lit(False)).alias("runs_into"),
            )

        return F.transform(hits, one)

    every = frame.select("key", F.explode(F.concat(*map(found, PATTERNS))).alias("m")).select("key", "m.*")
    counted = every.groupBy(every.columns).agg(F.count("*").alias("copies"))
    passed = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    skipped = F.coalesce(F.sum(F.col("gap") + F.length("hit")).over(passed), F.lit(0))
    placed = counted.withColumn("start", (skipped + F.col("gap")).cast("long"))
    return placed.filter(valid(F.col("kind"), F.col("hit"))).select(
        "key", "kind", "start", (F.col("start") + F.length("hit")).alias("end"), "hit", "before", "after", "goes_on", "runs_into", "copies"
    )


def near_terms(found: DataFrame) -> DataFrame:
    """(key, kind, term, start, end, hit, copies) of whole terms within CONTEXT of a match.

    Words that the context cuts off, or of which a match is a part, are not whole.
    """
    first, last = f"^{TERM}", f"{TERM}\\z"

    def without(text: Column, part: str, where: Column) -> Column:
        return F.when(where, F.regexp_replace(text, part, "")).otherwise(text)

    begun = without(F.col("before"), first, (F.length("before") > CONTEXT) | F.col("goes_on"))
    ended = without(F.col("after"), first, F.col("hit").rlike(last))
    sides = F.array(
        F.struct((F.col("start") - F.length(begun)).alias("base"), without(begun, last, F.col("hit").rlike(first)).alias("text")),
        F.struct(
            (F.col("end") + F.length("after") - F.length(ended)).alias("base"),
            without(ended, last, (F.length("after") > CONTEXT) | F.col("runs_into")).alias("text"),
        ),
    )
    sided = found.select("key", "kind", "hit", "copies", F.explode(sides).alias("side"))
    cut = sided.select(
        "key", "kind", "hit", "copies", "side.base", terms(F.col("side.text")).alias("words"), F.split(F.col("side.text"), TERM, -1).alias("gaps")
    )
    # A context has at most CONTEXT words, so the sums before each of them are short.
    nth = F.explode(F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)))
    each = cut.withColumn("nth", nth)
    length = lambda total, x: total + F.length(x)
    ahead = F.aggregate(F.slice("words", F.lit(1), F.col("nth")), F.lit(0), length) + F.aggregate(
        F.slice("gaps", F.lit(1), F.col("nth") + 1), F.lit(0), length
    )
    word = F.get(F.col("words"), F.col("nth"))
    placed = each.select("key", "kind", word.alias("word"), (F.col("base") + ahead).alias("start"), "hit", "copies")
    end = (F.col("start") + F.length("word")).alias("end")
    return placed.select("key", "kind", F.lower("word").alias("term"), "start", end, "hit", "copies")


def beside(near: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(kind, term, n_tk, n_k) of terms next to entities of a kind, in enough different texts."""
    places = near.groupBy("key", "kind", "term", "start").agg(F.max("copies").alias("copies"))
    joint = places.groupBy("kind", "term").agg(F.sum("copies").alias("n_tk"), F.count_distinct("key").alias("texts"))
    of_kind = keep(places.groupBy("kind").agg(F.sum("copies").alias("n_k")))  # one row per kind
    return keep(joint.filter(F.col("texts") >= support).drop("texts").join(F.broadcast(of_kind), "kind"))


def _disclosed(all_n: int, both: Column, own: Column, other: Column) -> Column:
    """PMI / IC of two things seen in ``both`` of ``all_n`` cases, the other of which is to be kept secret."""
    n = F.lit(float(all_n))
    ic = F.log2(n / other)
    return F.when(ic > 0, F.log2(n * both / (own * other)) / ic).otherwise(0.0)


def within(docs: DataFrame, found: DataFrame, all_docs: int, support: int = SUPPORT, least: float = GENERALISE) -> DataFrame:
    """(term, n_te, n_e) of terms that may give a single entity away, from the texts that hold one.

    A term is in no fewer documents than in those listed here, so what cannot reach the threshold goes.
    """
    digits = F.regexp_replace("hit", "[^0-9]", "")
    name = F.when(F.col("kind") == "email", F.lower("hit")).when(F.col("kind") == "ip", F.col("hit")).otherwise(digits)
    named = found.groupBy("key", F.concat_ws(":", "kind", name).alias("entity")).agg(F.max("copies").alias("copies"))
    named = keep(named)
    often = named.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("texts")).filter(F.col("texts") >= support)
    often = keep(often.drop("texts").withColumn("nth", F.monotonically_increasing_id()))
    held = keep(named.join(small(often), "entity").select("key", "copies", "nth", "n_e"))
    keys = keep(held.groupBy("key").agg(F.max("copies").alias("copies")))
    keys = keep(keys.withColumn("place", F.monotonically_increasing_id()))
    texts = docs.filter("text IS NOT NULL").select(digest(F.col("text")).alias("key"), "text").join(small(keys), "key")
    once = texts.groupBy("place", "copies").agg(F.any_value("text").alias("text"))
    lower = F.array_distinct(F.transform(terms(F.col("text")), F.lower)).alias("terms")
    inside = store(once.select("place", "copies", lower).select("place", "copies", F.explode("terms").alias("term")), "terms-inside")
    some = inside.groupBy("term").agg(F.sum("copies").alias("n_some"), F.count("*").alias("texts")).filter(F.col("texts") >= support)
    held = keep(held.join(small(keys.select("key", "place")), "key").select("place", "nth", "n_e"))
    joint = inside.join(small(held), "place").groupBy("nth", "n_e", "term").agg(F.sum("copies").alias("n_te"), F.count("*").alias("texts"))
    able = joint.filter(F.col("texts") >= support).join(some.select("term", "n_some"), "term")
    able = able.filter(_disclosed(all_docs, F.col("n_te"), F.col("n_some"), F.col("n_e")) >= least)
    return keep(able.select("term", "n_te", "n_e").distinct())


def document_terms(docs: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (key, term) and what ``wanted`` has besides, each wanted term of a document once; the ``columns`` of it."""
    lower = F.array_distinct(F.transform(terms(F.col("text")), F.lower))
    # In one step with the explode, the digest of the text would be taken once for each term.
    listed = docs.filter("text IS NOT NULL").select(digest(F.col("text")).alias("key"), lower.alias("terms"))
    return joined(listed.select("key", F.explode("terms").alias("term")), wanted, "term", columns)


def telling(docs: DataFrame, found: DataFrame, near: DataFrame, support: int = SUPPORT, least: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """(kind, term, disclosed) of terms that tell of a kind, and (key, term, disclosed) of those that
    give a single entity away, in all texts that hold them."""
    n, all_docs = docs.agg(F.sum(n_terms(F.col("text"))), F.count("text")).first()
    of_kind, of_entity = beside(near, support), within(docs, found, all_docs, support, least)
    counts = term_counts(docs, keep(of_kind.select("term").distinct()))
    kinds = of_kind.join(counts, "term").select("kind", "term", _disclosed(n or 0, F.col("n_tk"), F.col("n"), F.col("n_k")).alias("disclosed"))
    held = document_terms(docs, keep(of_entity.select("term").distinct()), ["term"]).groupBy("term").agg(F.count("*").alias("n_t"))
    ones = of_entity.join(held, "term").select("term", _disclosed(all_docs, F.col("n_te"), F.col("n_t"), F.col("n_e")).alias("disclosed"))
    ones = keep(ones.groupBy("term").agg(F.max("disclosed").alias("disclosed")).filter(F.col("disclosed") >= least))
    places = document_terms(docs, ones, ["key", "term", "disclosed"]).distinct()
    return keep(kinds.filter(F.col("disclosed") >= least)), keep(places)


def occurrences(docs: DataFrame, told: DataFrame) -> DataFrame:
    """(key, start, end, disclosed) of each occurrence of the terms told, rows (key, term, disclosed).

    Copies of a text are searched each by itself and give equal rows, so no text is shuffled.
    """
    asked = told.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosed"))).alias("told"))  # terms of one text
    texts = docs.filter("text IS NOT NULL").select(digest(F.col("text")).alias("key"), "text").join(small(keep(asked)), "key")
    parts = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), terms(F.col("text")).alias("word"))

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["word"]), F.lit(0))
        disclosed = F.try_element_at(F.col("told"), F.coalesce(F.lower(part["word"]), F.lit("")))
        here = F.struct(start.alias("start"), end.alias("end"), disclosed.alias("disclosed"))
        return F.struct(end.alias("at"), F.when(disclosed.isNull(), done["hits"]).otherwise(F.concat(done["hits"], F.array(here))).alias("hits"))

    none = F.array().cast("array<struct<start:bigint,end:bigint,disclosed:double>>")
    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("hits"))
    hits = F.aggregate(parts, first, step, lambda done: done["hits"])
    return texts.select("key", F.explode(hits).alias("hit")).select("key", "hit.*")


def spans(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end, removed): entities, telling terms beside them, and terms that tell one of them."""
    base = keep(matches(docs))
    near = keep(near_terms(base))
    of_kind, of_entity = telling(docs, base, near)
    told = near.join(small(of_kind), ["kind", "term"]).select("key", "start", "end", "disclosed")
    told = told.unionByName(occurrences(docs, of_entity)).groupBy("key", "start", "end").agg(F.max("disclosed").alias("disclosed"))
    entities = base.select("key", "kind", "start", "end", F.lit(True).alias("removed"))
    terms_told = told.select("key", F.lit("term").alias("kind"), "start", "end", (F.col("disclosed") >= REMOVE).alias("removed"))
    # A term overlaps an entity if one that begins no later ends after its start, or the next begins before its end.
    is_term = F.col("kind") == "term"
    order = Window.partitionBy("key").orderBy("start", is_term)
    ahead = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = entities.unionByName(terms_told)
    marked = every.withColumn("ended", F.max(F.when(~is_term, F.col("end"))).over(ahead)).withColumn(
        "begins", F.min(F.when(~is_term, F.col("start"))).over(behind)
    )
    apart = (F.coalesce("ended", F.lit(0)) <= F.col("start")) & (F.col("begins").isNull() | (F.col("begins") >= F.col("end")))
    return marked.filter(~is_term | apart).select(every.columns)


def listed(found: DataFrame) -> DataFrame:
    """One row per text with spans: key, and its spans in order as an array."""
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).alias("order")
    return found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", order, "kind", "end", "removed"))).alias("all"))


def _joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: numbers of entities, the digest of their spans, and all spans."""
    found = listed(spans(docs.select("text")))
    rows = docs.select("doc_id", digest(F.col("text")).alias("key")).join(found, "key", "left")
    every = F.coalesce("all", F.array().cast("array<struct<start:bigint,order:bigint,kind:string,end:bigint,removed:boolean>>"))
    return rows.select(
        "doc_id",
        *(_count(every, kind).alias(f"n_{kind}") for kind in PATTERNS),
        F.sha2(_joined(F.filter(every, lambda s: s["kind"] != "term")), 256).alias("base_sha256"),
        _joined(every).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """The documents with their columns; entities are marked by kind, terms marked or removed."""
    found = listed(spans(docs.select("text")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), digest(F.col("text")).alias("key")).join(found, "key", "left")
    text = F.col("row.text")

    def replaced(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        mark = F.when(s["kind"] != "term", F.concat(F.lit("<"), s["kind"], F.lit(">"))).when(s["removed"], "").otherwise("<term>")
        between = text.substr((done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(done["text"], between, mark)).otherwise(done["text"]).alias("text"),
        )

    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))
    rest = lambda done: F.concat(done["text"], text.substr((done["at"] + 1).cast("int"), F.length(text)))
    changed = F.when(F.col("all").isNull(), text).otherwise(F.aggregate("all", first, replaced, rest))
    return rows.select(*((changed if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns))
