"""The methods by themselves, and the ways that only large inputs take."""

from __future__ import annotations

import heapq
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillroll.llm import (
    base,
    bwt,
    decontaminate,
    fingerprints,
    kernels,
    langid,
    lsh_forest,
    mixing,
    sanitise,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)
from tillroll.llm.components import components


@pytest.fixture
def one_by_one(monkeypatch):
    """Nothing is small enough to be broadcast whole."""
    monkeypatch.setattr(base, "BROADCAST_ROWS", 3)


def texts(n, length, seed):
    r = random.Random(seed)
    words = [f"w{r.randrange(10**6)}" for _ in range(400)]
    return [" ".join(r.choices(words, k=length)) for _ in range(n)]


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"x{r.randrange(10**9)}" if r.random() < share else w for w in text.split(" "))


def test_words_shingles_and_hashes_follow_the_text():
    column = pa.array(["One two\tTHREE ", None, "", "é é  é", "one", " two three one two three four"])
    for limit in (1, 10, 10**6):
        seen = []
        for lo, hi, data, offsets in kernels.chunks(column, limit):
            words = kernels.Words(data, offsets)
            for row in range(hi - lo):
                a, b = words.offsets[row], words.offsets[row + 1]
                seen.append([bytes(data[s:e]) for s, e in zip(words.start[a:b], words.end[a:b])])
            values, rows = words.shingles(3)
            assert (np.diff(rows) == [max(len(w) - 2, 1) if w else 0 for w in seen[lo:hi]]).all()
        assert seen == [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode()) for t in column.to_pylist()]
    whole = kernels.Words(*next(kernels.chunks(column))[2:])
    by_word = {}
    for w, h in zip([x for row in seen for x in row], whole.hash):
        by_word.setdefault(w.lower(), set()).add(int(h))
    assert all(len(h) == 1 for h in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)


def test_components(spark):
    r = random.Random(3)
    for n in (20, 150):
        links = [(r.randrange(150), r.randrange(150)) for _ in range(n)] + [(i, i + 1) for i in range(200, 240)]
        root = {i: i for pair in links for i in pair}
        for _ in root:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        found = components(spark.createDataFrame(links, "a long, b long")).collect()
        assert {x["node"]: x["root"] for x in found} == root and len(found) == len(root)


def test_merged_transforms_find_the_repeated_runs():
    r = random.Random(5)
    letters = suffix_dedup.letters_of
    for trial in range(60):
        base_text = bytes(r.choice(b"ab") for _ in range(300)) if trial % 3 else b"a" * 300
        strings = []
        for _ in range(r.randrange(1, 9)):
            at = r.randrange(300)
            cut = bytearray((base_text * 2)[at : at + r.randrange(260)])
            for _ in range(r.randrange(3)):
                if cut:
                    cut[r.randrange(len(cut))] = r.choice(b"abc")
            strings.append(bytes(cut))
        shard = np.array([r.randrange(4) for _ in strings])
        found = set(zip(*(x.tolist() for x in bwt.repeated(strings, shard, 100, letters))))
        seen, want = set(), set()
        for i, s in enumerate(strings):
            for at in range(len(s) - 99):
                if s[at : at + 100] in seen:
                    want.add((i, at))
                seen.add(s[at : at + 100])
        assert found == want


def overlapping(spark):
    """Texts that share passages at all offsets, copies among them."""
    r = random.Random(8)
    passages = texts(4, 40, 1)
    rows = []
    for i in range(40):
        own = texts(1, r.randrange(5, 40), 100 + i)[0]
        cut = r.choice(passages)
        a = r.randrange(60)
        rows.append((i * 7 % 40, own[: r.randrange(200)] + cut[a : a + r.randrange(50, 200)] + own[50:]))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("group", [1, 8192])
def test_repeated_runs_whatever_the_size_of_a_group(spark, monkeypatch, one_by_one, group):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows, docs = overlapping(spark)
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.report(docs).collect()}
    assert found == brute.kept_bytes(rows)
    kept = {r["doc_id"]: len(r["kept"]) for r in suffix_dedup.deduplicated(docs).collect()}
    assert kept == {i: n - gone for i, (n, gone, _, _) in found.items()}


def near_copies(spark):
    """Copies around a hub that are alike to it and less so to one another, chains, and others."""
    hub = texts(1, 160, 11)[0]
    rows = [(500, hub)]
    rows += [(i, edited(hub, 0.02 + i % 5 * 0.008, i)) for i in range(90)]
    link = hub
    for i in range(12):
        link = edited(link, 0.03, 700 + i)
        rows.append((600 + i, link))
    rows += [(200 + i, t) for i, t in enumerate(texts(60, 80, 12))]
    rows += [(300 + i, rows[i][1].upper()) for i in range(10)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("region, deepest", [(1024, 16), (16, 16), (16, 5)])
def test_near_copies_in_crowded_regions(spark, monkeypatch, region, deepest):
    monkeypatch.setattr(lsh_forest, "REGION", region)
    monkeypatch.setattr(lsh_forest, "DEEPEST", deepest)
    rows, docs = near_copies(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in lsh_forest.near_copies(docs, 4).collect()}
    want = brute.components(rows)
    assert len({root for _, root in want.values()}) < len(want) - 40
    wrong = sum(found[i] != want[i] for i in want)
    assert wrong == 0


def test_near_copies_without_broadcasts(spark, one_by_one):
    rows, docs = near_copies(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in lsh_forest.near_copies(docs, 4).collect()}
    assert found == brute.components(rows)
    kept = {r["doc_id"] for r in lsh_forest.one_of_each(docs, 4).collect()}
    assert kept == {root for _, root in found.values()}


def contaminated(spark):
    r = random.Random(21)
    items = [(str(i), t) for i, t in enumerate(texts(12, 25, 22))] + [("short", "tiny item"), ("none", "!!!"), ("0", "again")]
    rows = []
    for i in range(60):
        own = texts(1, 50, 300 + i)[0].split(" ")
        at, item = r.randrange(50), r.choice(items)[1].split(" ")
        a = r.randrange(max(1, len(item) - 12))
        rows.append((i, " ".join(own[:at] + item[a : a + r.randrange(8, 20)] + own[at:]).upper()))
    return rows + [(99, None), (98, "tiny, item."), (97, rows[0][1])], items


def test_benchmark_windows(spark, monkeypatch):
    monkeypatch.setattr(base, "BROADCAST_ROWS", 150)  # several slices of the vocabulary
    rows, items = contaminated(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    found = decontaminate.report(docs, bench).collect()
    import hashlib

    for r in found:
        n, hit, names = brute.hits(dict(rows)[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(names))
        assert r["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
    clean = {r["doc_id"] for r in decontaminate.without_hits(docs, bench).collect()}
    assert clean == {r["doc_id"] for r in found if not r["contaminated"]} and 0 < len(clean) < len(rows)


def test_proximity(spark):
    docs = spark.createDataFrame([("a x x b x x x x a b a",), ("b a",), (None,)], "text string")
    sought = spark.createDataFrame([("a", True), ("b", False)], "term string, leads boolean")
    index = decontaminate.postings(docs, sought)
    for within in (1, 2, 3, 7):
        found = sorted((r["position"], r["other_position"]) for r in decontaminate.proximity_matches(index, "a", "b", within).collect())
        words = ["a x x b x x x x a b a".split(" "), ["b", "a"]]
        assert found == sorted(
            (i, j) for w in words for i, x in enumerate(w) for j, y in enumerate(w) if x == "a" and y == "b" and abs(i - j) <= within
        )


def test_telling_terms_are_found_and_taken_out(spark):
    r = random.Random(31)
    rows = []
    for i in range(300):
        words = texts(1, 30, 400 + i)[0]
        rows.append((i, f"{words} the mailbox is user{i}@site{i}.org here {words}" if i % 10 == 0 else f"{words} the here {words}"))
    docs = spark.createDataFrame([(*x, "k") for x in rows], "doc_id long, text string, key string")
    found = {x["doc_id"]: x for x in sanitise.report(docs).collect()}
    for i, text in rows:
        spans = [s.split(":") for s in found[i]["spans"].split(",") if s]
        told = {text[int(a) : int(b)] for kind, a, b in spans if kind == "term"}
        assert ("mailbox" in told) == (i % 10 == 0) and "the" not in told
        assert found[i]["n_email"] == (i % 10 == 0)
    clean = {x["doc_id"]: x for x in sanitise.sanitised(docs).collect()}
    assert clean[0].asDict().keys() == {"doc_id", "text", "key"}
    assert "mailbox" not in clean[0]["text"] and "@" not in clean[0]["text"] and "<email>" in clean[0]["text"]
    assert clean[1]["text"] == rows[1][1]
    assert r is not None


def test_entities_at_odd_places(spark):
    odd = [
        "a@b.c_d@e.f x@y z@.q a@b..c 1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 10.0.0.7 0.00.000.0 300.0.0.1 999999999999999999999.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000 +1 (555) 010-9999 +12 +1234567890123456",
        "𝒳é@b.c " + "x" * 3000 + "@" + "y." * 2000 + "z " + "9" * 5000,
        "+1+2 (3) 4 5 6 7 8 9 0 -. 1.1.1.1@1.1.1.1",
    ]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for row in sanitise.report(docs).collect():
        want = ",".join(f"{k}:{a}:{b}" for a, k, b in brute.base_spans(odd[row["doc_id"]]))
        assert row["spans"] == want


def test_sketches_merge_and_estimate(spark):
    a, b = texts(2, 900, 41)
    common = a[: len(a) // 2] + " " + b[: len(b) // 2]
    rows = spark.createDataFrame([(0, a), (1, common), (2, a[: len(a) // 2]), (3, a[len(a) // 2 :])], "doc_id long, text string")
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(rows).collect()}
    made = spark.createDataFrame([(prints[0], prints[1], prints[2], prints[3])], "a string, b string, c string, d string")
    x = made.select(
        fingerprints.resemblance(F.col("a"), F.col("b")).alias("alike"),
        fingerprints.containment(F.col("c"), F.col("a")).alias("inside"),
        fingerprints.distinct_count(F.col("a")).alias("n"),
        fingerprints.resemblance(fingerprints.merge(F.col("c"), F.col("d")), F.col("a")).alias("whole"),
    ).first()
    assert abs(x["alike"] - 1 / 3) < 0.15 and x["inside"] > 0.8 and abs(x["n"] - 896) < 250 and x["whole"] > 0.95
    short = np.array([1, 5, 9], np.uint64)
    assert fingerprints.likeness(short, np.array([5, 9], np.uint64)) == 2 / 3


def test_targets_of_sources_are_levelled_by_weight(spark):
    docs = spark.createDataFrame(
        [(i, "w " * n, s) for i, (n, s) in enumerate([(1000, "a"), (10, "b"), (10, "c"), (0, "d"), (300, None), (40, "Z")])],
        "doc_id long, text string, source string",
    )
    found = {r["doc_id"]: r for r in mixing.report(docs).collect()}
    weights = {5: 1, 0: 2, 1: 3, 2: 1, 3: 2, 4: 3}
    size = {i: r["source_size"] for i, r in found.items()}
    target, open_, left = {}, set(size), sum(size.values())
    while True:
        share = {i: left * weights[i] / sum(weights[j] for j in open_) for i in open_}
        over = {i for i in open_ if share[i] >= 3 * size[i]}
        if not over:
            break
        target |= {i: 3.0 * size[i] for i in over}
        open_ -= over
        left -= sum(3 * size[i] for i in over)
    target |= share
    assert {i: round(r["target"], 6) for i, r in found.items()} == {i: round(t, 6) for i, t in target.items()}
    assert all(r["taken"] <= 3 * r["size"] for r in found.values())


def test_copies_come_near_the_targets(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 50 + 1).cast("int")).alias("text"),
        F.concat(F.lit("s"), F.least(F.col("id") % 7, F.lit(3)).cast("string")).alias("source"),
    )
    by_source = mixing.report(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source")
    for r in by_source.agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect():
        assert abs(r["taken"] - r["target"]) < 0.06 * r["target"]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.agg(F.sum(F.col("doc_id") % 50 + 1)).first()[0] == mixing.report(docs).agg(F.sum("taken")).first()[0]


def test_shards_are_those_of_plain_scheduling(spark):
    """Many groups of a size, copies, one group larger than a shard; loads as if taken one by one."""
    r = random.Random(71)
    rows = [(i, "x" * r.choice([0, 3, 3, 3, 40, 41, r.randrange(200)]) + f"{i % 900:04}") for i in range(3_000)]
    rows += [(5_000 + i, "copy " * 30) for i in range(400)] + [(6_000, None), (6_001, "")]
    sizes = {}
    for _, text in rows:
        sizes[text] = sizes.get(text, 0) + len(text or "") + 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shards, buckets in ((16, 8), (3, 1), (1, 2)):
        heap = [0] * shards
        for size in sorted(sizes.values(), reverse=True):
            heapq.heapreplace(heap, heap[0] + size)
        found = sharding.shards(docs, shards, buckets).collect()
        loads = [sum(x["size"] for x in found if x["shard"] == s) for s in range(shards)]
        assert len(found) == len(rows) and sorted(loads) == sorted(heap)
        shard_of = {}
        assert all(shard_of.setdefault((x["text_crc32"], x["size"]), x["shard"]) == x["shard"] for x in found)
    again = {x["doc_id"]: x["shard"] for x in sharding.shards(docs.repartition(5, "text"), 16, 8).collect()}
    assert again == {x["doc_id"]: x["shard"] for x in sharding.shards(docs, 16, 8).collect()}


def test_many_groups_of_a_size_are_dealt_as_one_by_one():
    r = random.Random(72)
    for _ in range(300):
        loads, size, n = [r.randrange(60) for _ in range(r.randrange(1, 7))], r.randrange(1, 20), r.randrange(0, 90)
        heap = [(load, shard) for shard, load in enumerate(loads)]
        heapq.heapify(heap)
        counts = [0] * len(loads)
        for _ in range(n):
            load, shard = heap[0]
            heapq.heapreplace(heap, (load + size, shard))
            counts[shard] += 1
        assert sharding.shares(loads, size, n) == counts


def test_words_of_two_languages_in_one_text(spark):
    r = random.Random(51)
    one = ["".join(r.choices("aeiou", k=2)) + "ng" for _ in range(80)]
    two = ["z" + "".join(r.choices("bdkpt", k=3)) for _ in range(80)]
    rows = [(i, " ".join(r.choices(one if i % 2 else two, k=60)), "x" if i % 2 else "y") for i in range(200)]
    field = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = " ".join(r.choices(one, k=15) + r.choices(two, k=15))
    data = np.frombuffer(mixed.encode(), np.uint8)
    words, found = langid.word_marginals(field, data, np.array([0, len(data)]))
    assert field.languages == ["x", "y"] and found.shape == (30, 2)
    assert (found.argmax(1) == [0] * 15 + [1] * 15).all() and np.allclose(found.sum(1), 1)
    assert field.transitions[0, 0] > field.transitions[0, 1]


def test_forward_backward_sums_over_all_paths():
    import itertools

    r = np.random.default_rng(2)
    field = langid.Field(["a", "b", "c"], np.zeros((1, 3)), r.normal(size=(3, 3)))
    scores, lengths = r.normal(size=(9, 3)), np.array([4, 1, 3, 1])
    starts = np.cumsum(lengths) - lengths
    found, pairs = field.marginals(scores, starts, lengths)
    want, want_pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for s, n in zip(starts, lengths):
        weight = {
            p: np.exp(sum(scores[s + i, x] for i, x in enumerate(p)) + sum(field.transitions[x, y] for x, y in zip(p, p[1:])))
            for p in itertools.product(range(3), repeat=int(n))
        }
        total = sum(weight.values())
        for p, w in weight.items():
            for i, x in enumerate(p):
                want[s + i, x] += w / total
            for x, y in zip(p, p[1:]):
                want_pairs[x, y] += w / total
    assert np.allclose(found, want) and np.allclose(pairs, want_pairs)


def test_spelling_models_give_distributions(spark):
    r = random.Random(61)
    plain = ["".join(r.choices("abcde", k=r.randrange(1, 6))) for _ in range(200)]
    rows = [(int(i % 5 == 0), int(i % 4 == 0), " ".join(r.choices(plain, k=20) + (["vile"] if i % 5 == 0 else []))) for i in range(100)]
    labelled = spark.createDataFrame(rows, "toxic int, calibrates int, text string")
    asked = spark.createDataFrame([("abc de",), ("abc vile de",), ("",), (None,)], "text string")
    found, _, both = toxicity.fit(labelled)
    value = [x["value"] for x in toxicity.valued(asked.coalesce(1), found).collect()]
    assert both and len(found) == 1 and value[1] > 0.3 > value[0] and value[2] == value[3] == 0
    models = found[0]
    # What the longest context and the shared ones give all symbols after "a" sums to one.
    symbols = np.arange(258) + 1
    for context in ((toxicity._START + 1) << 9, (98 << 9) | ((toxicity._START + 1) << 18)):
        gram = symbols | context
        shared = np.full(258, 1 / 258)
        n = 1 if context < 1 << 18 else 2
        for length in range(n):
            own = toxicity.cut(gram, length)
            seen, kinds = models.after[own >> 9].T
            kept = np.maximum(models.follows[own][:, 0] - 0.75, 0) + 0.75 * kinds * shared
            shared = np.where(seen > 0, kept / np.maximum(seen, 1), shared)
        assert abs(shared.sum() - 1) < 1e-4


def test_url_models_tell_accepted_from_rejected(spark):
    r = random.Random(71)
    good, bad = ["news", "blog", "wiki"], ["spin", "luck", "slot"]
    rows = []
    for i in range(600):
        word = r.choice(good if i % 2 else bad)
        host = f"{word}{r.randrange(99)}.{'com' if i % 2 else 'net'}"
        rows.append((i, f"http://{host}/{'a' if i % 2 else 'es'}/{r.randrange(999)}"))
    rows += [(1000 + i, f"http://{w}.org/x/{i}") for i, w in enumerate(good + bad)]
    found = {x["page_id"]: x for x in url_filter.verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert [found[1000 + i]["score"] > 0 for i in range(6)] == [True] * 3 + [False] * 3


def around_one_text(spark):
    """Edited copies of one text at 0.8 and more of it, many of them linked by few others alone."""
    hub = texts(1, 160, 81)[0]
    rows = [(500, hub)] + [(i, edited(hub, 0.018 + i % 9 * 0.004, 900 + i)) for i in range(220)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string")


def test_near_copies_of_different_blocks_are_compared(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 16)
    monkeypatch.setattr(lsh_forest, "DEEPEST", lsh_forest.DEPTH)
    rows, docs = around_one_text(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in lsh_forest.near_copies(docs, 4).collect()}
    want = brute.components(rows)
    assert sum(found[i] != want[i] for i in want) == 0


def test_near_copies_that_fall_apart_at_more_numbers_are_compared(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "REGION", 16)
    rows, docs = around_one_text(spark)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in lsh_forest.near_copies(docs, 4).collect()}
    want = brute.components(rows)
    assert sum(found[i] != want[i] for i in want) == 0


def test_terms_that_tell_one_entity_are_taken_everywhere(spark):
    far = "filler words " * 20
    rows = []
    for i in range(200):
        words = texts(1, 30, 2000 + i)[0]
        held = f"{words} 𝒳 Zweigelt {far} the Anna@site.org or anna@SITE.org here" if i % 20 == 0 else f"{words} 𝒳 {far} the or here"
        rows.append((i, held + (" zweigelt" if i == 7 else "")))
    rows += [(300 + i, rows[1][1] + " copied one@other.org") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {x["doc_id"]: x["spans"] for x in sanitise.report(docs).collect()}
    for i, text in rows:
        spans = [s.split(":") for s in found[i].split(",") if s]
        told = [text[int(a) : int(b)] for kind, a, b in spans if kind == "term"]
        assert told == (["Zweigelt"] if i % 20 == 0 and i < 200 else ["zweigelt"] if i == 7 else []), (i, told)
