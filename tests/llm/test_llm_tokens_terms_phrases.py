"""Byte-level BPE, source divergence and collocations against plain versions of them."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
from array import array
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from tillroll.llm import byte_bpe, collocations, divergence, langid, sanitise
from tillroll.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
EMPTY = hashlib.sha256(b"").hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    return brute.odd_documents(spark).cache()


def library(lines: bytes, pattern: str = public_tokenizers.PATTERN) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def rank_file(tokens: list[bytes]) -> bytes:
    return b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))


def ids_of(encoder: byte_bpe.Encoder, text: str) -> list[int]:
    return list(array("I", b"".join(encoder.blocks(text))))


# --- byte-level BPE


def some_texts(n: int, tokens: list[bytes], seed: int = 3):
    r = random.Random(seed)
    alphabets = ["abcdefgh", " \n\tab'sre", "éüñ漢字한국кириллица", "0123456789", "!@#$%^&*()-=", "aab", "​́𝒳😀 a", "\0\x7f\x80 "]
    for i in range(n):
        if i % 4 == 3:
            yield b"".join(r.choices(tokens, k=5)).decode("utf-8", "ignore")
        else:
            yield "".join(r.choices(r.choice(alphabets), k=r.randrange(1, 50)))


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_ids_are_those_of_the_library(name):
    lines = byte_bpe.read_ranks(public_tokenizers.path(name))
    encoder, own = byte_bpe.Encoder(lines, public_tokenizers.PATTERN), library(lines)
    tokens = list(encoder.bpe.rank)
    for text in some_texts(4_000, tokens):
        assert ids_of(encoder, text) == own.encode_ordinary(text)
        assert b"".join(map(encoder.decode, encoder.blocks(text))) == text.encode()


def test_ranks_that_merging_never_reaches():
    """``abc`` is listed, but ``bc`` comes before ``ab``, and ``a`` with ``bc`` is what remains."""
    r = random.Random(5)
    for _ in range(60):
        single = [bytes([i]) for i in range(256)]
        made = {bytes(r.choices(b"abc", k=r.randrange(2, 6))) for _ in range(12)}
        lines = rank_file(single + r.sample(sorted(made), len(made)))
        encoder, own = byte_bpe.Encoder(lines, "[^ ]+| "), library(lines, "[^ ]+| ")
        rising = all(rank > max(parts) for rank, parts in encoder.bpe.parts.items() if encoder.bpe.size[rank] > 1)
        assert rising or len(encoder.bpe.parts) < len(encoder.bpe.rank)
        if rising:
            for _ in range(40):
                text = "".join(r.choices("abc ", k=r.randrange(1, 25)))
                assert ids_of(encoder, text) == own.encode_ordinary(text)


def test_memos_and_blocks_change_nothing(monkeypatch):
    lines = byte_bpe.read_ranks(PATH)
    text = "".join(some_texts(300, [b"x"]))
    want = ids_of(byte_bpe.Encoder(lines, public_tokenizers.PATTERN), text)
    for name, value in {"PIECES": 2, "PAIRS": 3, "LONG_TEXT": 10, "LONG_PIECE": 4}.items():
        monkeypatch.setattr(byte_bpe, name, value)
    assert ids_of(byte_bpe.Encoder(lines, public_tokenizers.PATTERN), text) == want


def test_a_piece_without_end():
    encoder = byte_bpe.Encoder(byte_bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    text = "ab" * 300_000
    assert encoder.decode(b"".join(encoder.blocks(text))) == text.encode()
    assert ids_of(encoder, text[:2_000]) == library(byte_bpe.read_ranks(PATH)).encode_ordinary(text[:2_000])


def test_encoded_documents(spark):
    own = library(byte_bpe.read_ranks(PATH))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{brute.SF_DIR}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op11_byte_bpe"](spark, brute.SF_DIR).collect()}
    assert found.keys() == texts.keys()
    for i, text in texts.items():
        ids = own.encode_ordinary(text)
        assert found[i]["n_tokens"] == len(ids)
        assert found[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_documents_are_encoded_and_decoded(spark, odd):
    rows = byte_bpe.report(odd, PATH, public_tokenizers.PATTERN).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert [r["ids_sha256"] for r in rows if r["doc_id"] in (1, 2)] == [EMPTY, EMPTY]
    full = byte_bpe.encoded(odd, PATH, public_tokenizers.PATTERN, "n")
    assert full.columns == odd.columns and dict(full.dtypes)["n"] == "array<int>"
    back = byte_bpe.decoded(full, PATH, "n", "words")
    assert all(r["words"] == (r["text"] or "") for r in back.collect())
    assert byte_bpe.report(brute.empty_documents(spark), PATH, public_tokenizers.PATTERN).collect() == []


# --- divergence


def plain_audit(docs, documents=30, top=50):
    occurrences, holders, groups = Counter(), Counter(), set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = Counter(brute_terms(text or ""))
        for term, n in found.items():
            occurrences[lang, source, term] += n
            holders[lang, term] += 1
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (l, t), n in holders.items() if l == lang and n >= documents)
        sources = sorted(s for l, s in groups if l == lang)

        def shares(names):
            counts = {t: sum(occurrences[lang, s, t] for s in names) for t in kept}
            n = sum(counts.values()) + 5 * len(kept)
            return counts, {t: 1 + 10**9 * (c + 5) // n for t, c in counts.items()}

        own, whole = {s: shares([s]) for s in sources}, shares(sources)[1]
        for s in sources:
            counts, p = own[s]
            pairs = [(-sum(abs(p[t] - own[o][1][t]) for t in kept), o.encode()) for o in sources if o != s]
            terms = [(whole[t] - p[t], t.encode()) for t in kept if counts[t] and p[t] > whole[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(rows, 1)}
    return out


def brute_terms(text):
    import re

    return [t.translate(brute.LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]


def source_documents(n=260, seed=2):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("um", "Or", "é", "𝒳", "漢", "zz") for b in "abcdefgh"]
    for i in range(n):
        source = f"s{r.randrange(7)}" if i % 9 else None
        weights = [1 + (hash_of(w, source) % 5) for w in words]
        text = " ".join(r.choices(words, weights, k=r.randrange(0, 40))) if i % 31 else None
        yield (r.choice(["en", "fr", None]), source, text)
    yield ("xx", "a", "1 2 3")
    yield ("xx", "b", None)
    yield ("yy", "a", "lone lone")


def hash_of(word, source):
    return int(hashlib.md5(f"{word}{source}".encode()).hexdigest(), 16)


def test_audit_against_brute_force(spark):
    rows = list(source_documents())
    docs = spark.createDataFrame([(i, t, l, s, 1, "k", 2) for i, (l, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, rank int, item string, n long")
    want = plain_audit(rows, 10, 6)
    assert {tuple(r) for r in divergence.audit(docs, 10, 6).collect()} == want
    assert {tuple(r) for r in divergence.audit(docs.repartition(7, "text"), 10, 6).collect()} == want
    assert {p for _, _, p, *_ in want} == {"pair", "term"} and ("xx", "a", "pair", "b", 0, 1) in want


def test_blocks_of_sources_and_slices_of_terms_change_nothing(spark):
    rows = list(source_documents())
    docs = spark.createDataFrame([(t, l, s) for l, s, t in rows], "text string, lang string, source string")
    kept, groups = divergence.counts(docs, 10)
    pairs = lambda **how: {tuple(r) for r in divergence.distances(kept, groups, **how).collect()}
    want = pairs()
    assert len(want) > 60
    assert pairs(size=2) == pairs(size=3, laid=20) == pairs(size=1, laid=7) == want


def test_skyband_against_all_pairs(monkeypatch):
    r = np.random.default_rng(4)
    for rows, k, chunk in itertools.product((0, 1, 300), (1, 5), (1, 64, 512)):
        monkeypatch.setattr(divergence, "ROWS", chunk)
        group, a, b, term = r.integers(0, 3, rows), r.integers(0, 9, rows), r.integers(0, 9, rows), r.permutation(rows)
        dominated = [
            sum(group[j] == group[i] and a[j] >= a[i] and b[j] <= b[i] and term[j] < term[i] for j in range(rows)) for i in range(rows)
        ]
        assert sorted(divergence.skyband(group, a, b, term, k)) == [i for i in range(rows) if dominated[i] < k]


def test_terms_counted_in_small_steps(monkeypatch):
    texts = ["One one TWO é", "", "three one 4ever"]
    batch = pa.RecordBatch.from_arrays([pa.array(["l"] * 3), pa.array(["s", "s", "t"]), pa.array(texts)], names=["lang", "source", "text"])

    def total():
        sums = Counter()
        for part in divergence._counted(iter([batch])):
            for row in part.to_pylist():
                sums[row["source"], row["term"]] += np.array([row["n"], row["docs"]])
        return {k: tuple(v) for k, v in sums.items()}

    want = {("s", "one"): (2, 1), ("s", "two"): (1, 1), ("s", "é"): (1, 1), ("t", "three"): (1, 1), ("t", "one"): (1, 1), ("t", "ever"): (1, 1)}
    assert total() == want
    monkeypatch.setattr(divergence, "HELD", 1)
    monkeypatch.setattr(divergence, "LONG_TEXT", 2)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 1)
    assert total() == want


def test_audit_of_odd_documents_and_none(spark, odd):
    found = [tuple(r) for r in divergence.audit(odd).collect()]
    assert set(found) == plain_audit([(r["lang"], r["source"], r["text"]) for r in odd.collect()])
    assert len(found) == len(set(found)) and all(v == 0 for *_, v, _ in found)
    assert divergence.audit(brute.empty_documents(spark)).collect() == []


# --- collocations


def plain_phrases(docs, least=10, inside=50, top=2000):
    import re

    counts, total = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(brute.LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        rows = []
        for p, a in candidates.items():
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            longer = [n for q, n in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * n >= inside * a for n in longer):
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def phrase_documents(n=150, seed=8):
    r = random.Random(seed)
    words = ["Um", "or", "é", "𝒳y", "a", "b", "\x1c", " x", "the"] + [f"rare{i}" for i in range(40)]
    weights = [9] * 9 + [1] * 40
    for i in range(n):
        ends = [" ", " ", " ", "\t", ". ", ",", "\n", "  "]
        yield r.choice(["en", "de", None, ""]), "".join(w + r.choice(ends) for w in r.choices(words, weights, k=60)) + "or or or"


def test_phrases_against_brute_force(spark):
    rows = list(phrase_documents())
    docs = spark.createDataFrame([(l, t, 1, "p", 2, "w") for l, t in rows], "lang string, text string, a int, phrase string, n int, w1 string")
    want = plain_phrases(rows)
    assert len(want) > 60
    assert sorted(tuple(r) for r in collocations.phrases(docs).collect()) == want
    few = sorted(tuple(r) for r in collocations.phrases(docs.repartition(5, "text"), top=7, codes=3).collect())
    assert few == [r for r in want if r[1] <= 7]
    none = sorted(tuple(r) for r in collocations.phrases(docs, least=4, inside=90, codes=0).collect())
    assert none == plain_phrases(rows, 4, 90)


def test_scores_beyond_64_bits(spark):
    a, l, r = 3_000_000_000_000, 5_000_000_000_000, 7_000_000_000_001
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    from pyspark.sql import functions as F

    assert row.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (l * r)


def test_windows_in_blocks(monkeypatch):
    codes = collocations._Codes({w.encode(): i for i, w in enumerate("abcdefghi", 1)})
    texts = [b"a b c.d rare e f g h,i", b"", b"a a", b"rare", b"."]

    def found():
        keys, other = Counter(), 0
        for part, unlisted in collocations._numbers(collocations._gathered(collocations._joined(iter(texts))), codes):
            keys.update(tuple(int(k) >> shift & 2**21 - 1 for shift in (42, 21, 0)) for k in part)
            other += unlisted
        return keys, other

    want, other = found()
    assert want[2, 3, 0] == want[3, 0, 0] == want[9, 0, 0] == want[4, 0, 0] == want[1, 1, 0] == 1 and want.total() == 11 and other == 2
    monkeypatch.setattr(collocations, "LONG_TEXT", 1)
    for block in (1, 2, 3, 100):
        monkeypatch.setattr(collocations, "BLOCK", block)
        assert found() == (want, other)


def test_phrases_of_odd_documents_and_none(spark, odd):
    found = sorted(tuple(r) for r in collocations.phrases(odd).collect())
    assert found == plain_phrases([(r["lang"], r["text"]) for r in odd.collect()])
    assert collocations.phrases(brute.empty_documents(spark)).collect() == []


def test_tables_of_shares_that_fill_up(monkeypatch):
    monkeypatch.setattr(divergence, "ROWS", 2)
    r = np.random.default_rng(6)
    shares = r.integers(0, 50, (9, 5)) * (r.random((9, 5)) < 0.6)
    absent = np.arange(5) + 100
    rows = [(None, i, int(absent[i])) for i in range(5)]
    rows += [(f"t{t}", i, int(shares[t, i])) for t in range(9) for i in range(5) if shares[t, i]]
    held = [t for t in range(9) if shares[t].any()]
    full = np.where(shares > 0, shares, absent)[held]
    for cut in (1, 4, 7, 100):
        batches = []
        for at in range(0, len(rows), cut):
            term, nth, p = zip(*rows[at : at + cut])
            own = [pa.array(["l"] * len(term)), *(pa.array([0] * len(term)) for _ in range(3)), pa.array(term, pa.string()), pa.array(nth), pa.array(p)]
            batches.append(pa.RecordBatch.from_arrays(own, names=["lang", "block", "other", "part", "term", "nth", "p"]))
        found = [row for part in divergence._differences(8)(iter(batches)) for row in part.to_pylist()]
        assert {(x["nth"], x["against"]): (x["value"], x["seen"]) for x in found} == {
            (i, j): (int(abs(full[:, i] - full[:, j]).sum()), len(held)) for i in range(5) for j in range(5)
        }


# --- terms that give personal data away


def private_documents(seed, n=140):
    r = random.Random(seed)
    entities = [f"{w}@x.org" for w in "abcde"] + ["10.0.0.7", "4111 1111 1111 1111", "4111111111111111", "+31 20 555 0199", "999.1.1.1", "4111 1111 1111 1112"]
    beside = {"@": ["mail", "Post"], "+": ["call"], ".": ["host"], " ": ["card"]}
    common, rare = [f"c{i}" for i in range(25)], [f"r{i}" for i in range(60)]
    for _ in range(n):
        parts = r.choices(common, k=r.randrange(3, 50)) + r.choices(rare, k=2)
        for _ in range(r.choice([0, 0, 1, 2])):
            entity = r.choice(entities)
            mark = next((w for c, w in beside.items() if c in entity), ["x"])
            parts.insert(r.randrange(len(parts)), " ".join([r.choice(mark), entity, f"of{entities.index(entity)}" * r.choice([0, 1])]))
        yield r.choice([" ", ". ", " é "]).join(parts)


@pytest.mark.parametrize("seed", range(3))
def test_terms_that_reveal_against_brute_force(spark, seed):
    texts = list(private_documents(seed))
    texts += texts[:20] + texts[3:6] * 4
    want = brute.term_spans(texts, sanitise.CONTEXT, sanitise.SUPPORT, sanitise.GENERALISE)
    assert sum(map(bool, want.values())) > 5
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in sanitise.report(docs.repartition(4)).collect():
        spans = [s.split(":") for s in row["spans"].split(",") if s]
        found = sorted((int(a), int(b)) for kind, a, b in spans if kind == "term")
        assert found == want[texts[row["doc_id"]]]
        assert [s for s in spans if s[0] != "term"] == [[k, str(a), str(b)] for a, k, b in brute.base_spans(texts[row["doc_id"]])]


def test_sanitised_rows_with_any_names(spark):
    docs = spark.createDataFrame([(1, "a b@c.de f", "x", 2)], "key long, text string, all string, row int")
    out = sanitise.sanitised(docs)
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, "a <email> f", "x", 2)]


# --- languages


def test_texts_in_several_languages_stay(spark):
    import corpus_pipeline

    r = random.Random(9)
    words = {"en": "the of and water river", "de": "der und wasser fluss nicht", "fr": "le des eau rivière pas"}
    plain = [(i, " ".join(r.choices(words[l].split(), k=40)), l, "s", 1) for i, l in enumerate(r.choices(list(words), k=120))]
    mixed = [(1000 + i, " ".join(r.choices(sum((words[l].split() for l in ls), []), k=60)), None, "s", 1) for i, ls in enumerate([("en", "de"), ("de", "fr"), ("en", "de", "fr")] * 5)]
    none = [(2000, None, "en", "s", 1), (2001, "", "en", "s", 1), (2002, "12 ... 34", "de", "s", 1)]
    docs = spark.createDataFrame(plain + mixed + none, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.known_language(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(x[0] for x in plain + mixed)


def test_the_sample_of_languages_is_the_first_by_hash(spark):
    from pyspark.sql import functions as F

    rows = [(i, f"word{i} other words", "en" if i % 10 else "fr") for i in range(9_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashes = {x["doc_id"]: x["h"] for x in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    found = langid.sample(docs, 600).collect()
    for lang in ("en", "fr"):
        own = sorted((hashes[i], i, t) for i, t, l in rows if l == lang)[:300]
        assert sorted(bytes(x["chain"]).decode() for x in found if x["lang"] == lang) == sorted(t for *_, t in own)
