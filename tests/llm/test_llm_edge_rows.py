"""Every operator and stage on odd documents, on none, and on rows in another order."""

from __future__ import annotations

import brute
import corpus_pipeline
import pytest

from tillroll.llm import (
    decontaminate,
    fingerprints,
    langid,
    lsh_forest,
    mixing,
    sanitise,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)

ITEMS = [("1", brute._PASSAGE), ("2", None), ("3", "no id but words"), (None, "ONE two"), ("5", "...")]


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd_documents(spark).cache()


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id string, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(6, 1, 1), (7, 1, 0), (8, 0, 0), (10, 1, 0), (12, None, 1), (None, 1, 1), (99, 1, 1), (1, 1, 1), (8, 1, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


OPERATORS = {
    "langid": lambda d, i, l: langid.languages(d),
    "sanitise": lambda d, i, l: sanitise.report(d),
    "suffix_dedup": lambda d, i, l: suffix_dedup.report(d),
    "fingerprints": lambda d, i, l: fingerprints.edited(d),
    "lsh_forest": lambda d, i, l: lsh_forest.near_copies(d),
    "decontaminate": lambda d, i, l: decontaminate.report(d, i),
    "sharding": lambda d, i, l: sharding.shards(d),
    "toxicity": lambda d, i, l: toxicity.toxic(d, l),
    "mixing": lambda d, i, l: mixing.report(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document_and_the_same_in_any_order(spark, odd, items, labels, name):
    run = OPERATORS[name]
    first, again = run(odd, items, labels).collect(), run(odd.repartition(5, "n_chars"), items, labels).collect()
    ids = sorted((r["doc_id"] for r in first), key=str)
    assert ids == sorted((r["doc_id"] for r in odd.collect()), key=str)
    plain = lambda rows: sorted(str({k: round(v, 9) if isinstance(v, float) else v for k, v in r.asDict().items() if k != "slot"}) for r in rows)
    assert plain(first) == plain(again)


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents_no_rows(spark, items, labels, name):
    assert OPERATORS[name](brute.empty_documents(spark), items, labels).collect() == []


def test_empty_side_tables(spark, odd, items, labels):
    none = decontaminate.report(odd, items.limit(0)).collect()
    assert len(none) == odd.count() and not any(r["contaminated"] for r in none)
    scores = toxicity.toxic(odd, labels.limit(0)).collect()
    assert len(scores) == odd.count() and {r["score"] for r in scores} == {0.0}


@pytest.mark.parametrize("k", range(len(corpus_pipeline.STAGES)))
def test_stages_stand_odd_documents_and_none(spark, odd, items, k, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    name, stage = corpus_pipeline.STAGES[k]
    last = k == len(corpus_pipeline.STAGES) - 1
    for docs in (odd, brute.empty_documents(spark)):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / f"{name}-{docs is odd}"))
        assert last or out.columns == docs.columns


def test_language_of_texts_without_letters(odd):
    found = {r["doc_id"]: r for r in langid.languages(odd).collect()}
    assert {i for i, r in found.items() if r["lang_pred"] == "und"} >= {1, 2, 3, 9}
    assert found[2]["score"] == 0.0


def test_spans_of_null_and_blank_texts(odd):
    found = {r["doc_id"]: r for r in sanitise.report(odd).collect()}
    assert found[1]["spans"] == found[2]["spans"] == ""
    assert found[1]["base_sha256"] == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_copies_repeated_rows_and_ids_taken_twice_in_suffix_dedup(odd):
    found = {}
    for r in suffix_dedup.report(odd).collect():
        found.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert found[6][0] == found[6][1]
    # Texts 10 and 11 repeat themselves; 7 is a copy of 6, 8 holds its passage.
    assert found[7][0][0] == found[7][0][1] and found[7][0][2] == 1
    assert found[8][0][1] == len(brute._PASSAGE) + 1
    assert found[11] == [(5000, 4999, 1)]
    assert found[1] == found[2] == [(0, 0, 0)]


def test_fingerprint_cases(odd):
    found = {}
    for r in fingerprints.edited(odd).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert found[1][0]["fingerprint"] == "" and found[1][0]["near_edited"] == 1.0
    assert found[6][0]["fingerprint"] == found[7][0]["fingerprint"]
    assert len(found[4][0]["fingerprint"]) == fingerprints.DIGITS


def test_near_copies_cases(odd):
    found = {}
    for r in lsh_forest.near_copies(odd).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert [r["component_id"] for r in found[6] + found[7]] == [6, 6, 6]
    assert not found[7][0]["kept"] and found[2][0]["kept"] and found[2][0]["n_shingles"] == 0
    assert all(r["component_id"] is None and r["kept"] for r in found[None])


def test_equal_texts_share_a_shard_and_slots_have_no_gap(odd):
    rows = sharding.shards(odd).collect()
    by_shard, by_text = {}, {}
    for r in rows:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
        by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_urls(spark):
    rows = [
        (1, None, "h"), (2, "", "h"), (3, "no scheme.com/x", "h"), (4, "http://A.Example.COM/en/x?y#z", None),
        (5, "ftp://www.example.com/en/", "h"), (6, "http://b.net/es/", "h"), (7, "http://com", "h"), (8, "http://x.com/", "h"),
        (None, "http://c.org/a://b/c", "h"), (9, "http://mycom/", "h"), (10, "http://x.com/", "h"),
    ]
    pages = spark.createDataFrame([(*r, "v", "r") for r in rows], "page_id long, url string, html string, verdict string, rule string")
    found = {r["page_id"]: r for r in url_filter.verdicts(pages).collect()}
    assert len(found) == len(rows)
    expected = {
        1: ("", "", None), 2: ("", "", None), 3: ("", "", None), 4: ("a.example.com", "/en/x", "example.com/en/"),
        5: ("www.example.com", "/en/", "www.example.com/en/"), 6: ("b.net", "/es/", "net/es/"), 7: ("com", "", None),
        8: ("x.com", "/", "com/"), None: ("c.org", "/a://b/c", None), 9: ("mycom", "/", None),
    }
    for i, (host, path, rule) in expected.items():
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule)
    assert [found[i]["verdict"] for i in (4, 5, 6, 8)] == ["block", "allow", "block", "allow"]
    assert {r["verdict"] for r in found.values()} <= {"allow", "block"}
    assert url_filter.verdicts(pages.limit(0)).collect() == []
