"""The pipeline stage by stage against plain versions, each on what the stage before it kept."""

from __future__ import annotations

import heapq
from collections import Counter

import brute
import corpus_pipeline
import duckdb
import pytest

from tillroll.llm.base import store, table
from tillroll.llm.queries import MIXING_SQL


@pytest.fixture(scope="module")
def stages(spark):
    """Rows of documents, then of each stage."""
    docs = table(spark, brute.SF_DIR, "documents")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(store(stage(spark, frames[-1], brute.SF_DIR), f"test-{name}"))
    return {name: [r.asDict() for r in f.collect()] for name, f in zip(["documents", *(n for n, _ in corpus_pipeline.STAGES)], frames)}


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_texts_without_letters_go(stages):
    assert ids(stages["language_id"]) == sorted(r["doc_id"] for r in stages["documents"] if any(c.isalpha() for c in r["text"] or ""))


def test_the_least_of_each_class_stays(stages):
    before = [(r["doc_id"], r["text"]) for r in stages["language_id"]]
    assert ids(stages["near_dedup"]) == sorted({least for _, least in brute.components(before, 5).values()})
    assert len(stages["near_dedup"]) < len(before)


def test_documents_with_benchmark_passages_go(spark, stages):
    items = [(r["item_id"], r["text"]) for r in table(spark, brute.SF_DIR, "benchmark").collect()]
    before = stages["near_dedup"]
    clean = sorted(r["doc_id"] for r in before if not brute.hits(r["text"], items)[1])
    assert ids(stages["decontamination"]) == clean and len(clean) < len(before)


def test_copies_are_those_of_the_sql(stages):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(r["doc_id"], r["text"], r["source"]) for r in stages["decontamination"]])
    want = {i: taken // size for i, size, _, _, taken in con.execute(MIXING_SQL).fetchall() if size}
    found = Counter(r["doc_id"] for r in stages["mixing"])
    assert {i: n for i, n in want.items() if n} == {i: n for i, n in found.items() if i in want}
    plain = {r["doc_id"]: r for r in stages["documents"]}
    assert all(r == plain[r["doc_id"]] for r in stages["mixing"])


def test_shards_are_those_of_the_plain_heap(stages):
    sizes = Counter()
    for r in stages["mixing"]:
        sizes[r["text"]] += len((r["text"] or "").encode()) + 1
    heap = [0] * 16
    for size in sorted(sizes.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    loads = Counter()
    for r in stages["sharding"]:
        loads[r["shard"]] += r["size"]
    assert sorted(loads[s] for s in range(16)) == sorted(heap)
    assert ids(stages["sharding"]) == ids(stages["mixing"])


def test_run_gives_what_the_stages_give(spark, stages):
    found = [r.asDict() for r in corpus_pipeline.run(spark, brute.SF_DIR).collect()]
    key = lambda r: (r["doc_id"], r["shard"], r["slot"])
    assert sorted(found, key=key) == sorted(stages["sharding"], key=key)
