"""Languages of texts by a linear-chain conditional random field over their words.

A word, A-Z in lower case, has as features its prefixes and suffixes of up to ``AFFIX`` bytes, its
runs of three bytes, and itself, which learns the lexicon. Features are hashed into ``SLOTS`` places
and have a weight for each language; transitions between the languages of neighbouring words are
learned with them. Forward and backward passes over chains of up to ``CHAIN`` words give each word a
probability of each language, so a text in two languages has words of both. The language of a text
is the one with the largest mean probability over its words that have a letter; that mean is its
score.

The field is fitted on a bounded sample: of the documents that may be learned from, those with the
least hashes, ``SAMPLE`` in all and as many of each language, and of each of them up to ``CHAINS``
chains, evenly spread over the whole text. Each word is taken to be in its document's language. All
of every text is used when languages are predicted.

Cases: a null text and one without a letter are 'und', with score 0; a chain ends with its text; a
language of which the sample holds nothing is never predicted; without anything to learn from, all
texts are 'und'; an empty table gives no rows; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import keep, map_batches, small
from tillroll.llm.kernels import BLANK, Words, chunks, mixed, rows_of

SLOTS_LOG = 18
AFFIX = 4
CHAIN = 64
SAMPLE = 3000
CHAINS = 6
#: Chains with more bytes, which hold no ordinary words, are not sampled.
CHAIN_BYTES = 8192
EPOCHS = 4
BATCH = 128
RATE = 0.2

#: Bytes that can be part of a letter: ASCII letters and all of longer code points.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(words: Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all features, and where each word's begin; every word has some."""
    n = len(words.start)
    kinds = [mixed(words.hash + np.uint64(1))]
    for k in range(1, AFFIX + 1):
        kinds.append(mixed(words.part(words.start, np.minimum(words.start + k, words.end)) + np.uint64(2 * k)))
        kinds.append(mixed(words.part(np.maximum(words.end - k, words.start), words.end) + np.uint64(2 * k + 1)))
    runs = np.maximum(words.end - words.start - 2, 0)
    first = np.cumsum(runs) - runs
    at = np.arange(runs.sum()) - np.repeat(first - words.start, runs)
    counts = len(kinds) + runs
    starts = np.cumsum(counts) - counts
    out = np.empty(counts.sum(), np.uint64)
    for i, kind in enumerate(kinds):
        out[starts + i] = kind
    inside = np.ones(len(out), bool)
    inside[(starts[:, None] + np.arange(len(kinds))).ravel()] = False
    out[inside] = mixed(words.part(at, at + 3) + np.uint64(1000))
    return (out >> np.uint64(64 - SLOTS_LOG)).astype(np.int64), starts if n else np.zeros(0, np.int64)


def chains(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each chain, from the offsets of texts among the words."""
    counts = np.diff(offsets)
    pieces = -(-counts // CHAIN)
    order = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(offsets[:-1], pieces) + order * CHAIN
    return start, np.minimum(CHAIN, np.repeat(offsets[1:], pieces) - start)


@dataclass
class Field:
    """Weights of the features and of the transitions, and the languages they are for."""

    languages: list[str]
    weights: np.ndarray
    transitions: np.ndarray

    def emissions(self, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Score of each language for each word."""
        if not len(starts):
            return np.zeros((0, len(self.languages)))
        return np.add.reduceat(self.weights[places], starts, axis=0)

    def marginals(self, scores: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each word's language, and expected transitions summed over all chains."""
        n, k = len(start), len(self.languages)
        step = np.exp(self.transitions)
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        # Chains by length, so that those still going at any step are the first ones.
        going = np.searchsorted(-length, -np.arange(CHAIN), "left")
        seen = np.exp(scores - scores.max(1, keepdims=True))
        forward, out = np.zeros((CHAIN, n, k)), np.zeros((len(scores), k))
        pairs = np.zeros((k, k))
        for t in range(CHAIN):
            m = going[t]
            if not m:
                break
            here = seen[start[:m] + t]
            own = here if t == 0 else (forward[t - 1, :m] @ step) * here
            forward[t, :m] = own / own.sum(1, keepdims=True)
        backward = np.ones((n, k))
        for t in range(CHAIN - 1, -1, -1):
            m = going[t]
            if not m:
                continue
            own = forward[t, :m] * backward[:m]
            out[start[:m] + t] = own / own.sum(1, keepdims=True)
            back = backward[:m] * seen[start[:m] + t]
            if t:
                joint = forward[t - 1, :m, :, None] * step * back[:, None, :]
                pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
                back = back @ step.T
                backward[:m] = back / back.sum(1, keepdims=True)
        return out, pairs


def learn(texts: list[bytes], labels: list[str]) -> Field:
    """Fit a field by stochastic gradient on chains of words, each all in one language."""
    languages = sorted(set(labels))
    k = len(languages)
    label = np.array([languages.index(x) for x in labels])
    field = Field(languages, np.zeros((1 << SLOTS_LOG, k)), np.zeros((k, k)))
    squares, transition_squares = np.full_like(field.weights, 1e-2), np.full((k, k), 1e-2)
    random = np.random.Generator(np.random.PCG64(11))
    for _ in range(EPOCHS):
        order = random.permutation(len(texts))
        for lo in range(0, len(order), BATCH):
            batch = order[lo : lo + BATCH]
            data = np.frombuffer(b"".join(texts[i] for i in batch), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(texts[i]) for i in batch])])
            words = Words(data, offsets)
            places, starts = features(words, data)
            first, length = chains(words.offsets)
            if not len(first):
                continue
            found, pairs = field.marginals(field.emissions(places, starts), first, length)
            right = label[batch][rows_of(words.offsets)]
            found[np.arange(len(right)), right] -= 1
            of_word = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(places))))
            used, at = np.unique(places, return_inverse=True)
            slope = np.stack([np.bincount(at, found[of_word, i], len(used)) for i in range(k)], axis=1) / len(first)
            squares[used] += slope**2
            field.weights[used] -= RATE * slope / np.sqrt(squares[used])
            same = np.bincount(label[batch], np.maximum(np.bincount(rows_of(words.offsets), minlength=len(batch)), 1) - 1, k)
            slope = (pairs - np.diag(same)) / len(first)
            transition_squares += slope**2
            field.transitions -= RATE / 4 * slope / np.sqrt(transition_squares)
    field.weights = field.weights.astype(np.float32)
    return field


def sample(labelled: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """(lang, chain) of a bounded number of labelled documents (doc_id, text, lang)."""
    usable = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    counts = keep(usable.groupBy("lang").agg(F.count("*").alias("__n")))
    each = max(1, rows // max(1, counts.count()))
    # Only rows that are likely to be among the first of their language are ranked, so that no task
    # gathers them from all the others: twice as many as asked for, and a few.
    by_hash = F.xxhash64("doc_id")
    ahead = (by_hash.cast("double") + 2.0**63) / 2.0**64 < (2 * each + 100) / F.col("__n")
    ranked = Window.partitionBy("lang").orderBy(by_hash, "doc_id")
    ids = usable.select("doc_id", "lang").join(small(counts), "lang").filter(ahead).drop("__n")
    ids = ids.withColumn("__rank", F.row_number().over(ranked)).filter(F.col("__rank") <= each)
    picked = usable.join(small(ids.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, langs, pieces = batch.column(0).to_pylist(), [], []
            for lo, _, data, offsets in chunks(batch.column(1)):
                words = Words(data, offsets)
                start, length = chains(words.offsets)
                of = np.searchsorted(words.offsets, start, "right") - 1
                for row in np.unique(of):
                    own = np.flatnonzero(of == row)
                    for i in own[np.unique(np.linspace(0, len(own) - 1, CHAINS).astype(int))]:
                        a, b = words.start[start[i]], words.end[start[i] + length[i] - 1]
                        if b - a <= CHAIN_BYTES:
                            langs.append(names[lo + row])
                            pieces.append(data[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(pieces, pa.binary())], ["lang", "chain"])

    return map_batches(picked, run, "lang string, chain binary")


def fit(labelled: DataFrame, rows: int = SAMPLE) -> Field | None:
    """A field from a bounded sample of labelled documents; None without any."""
    found = sample(labelled, rows).toArrow().sort_by([("lang", "ascending"), ("chain", "ascending")])
    return learn(found["chain"].to_pylist(), found["lang"].to_pylist()) if found.num_rows else None


def word_marginals(field: Field, data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """The words of some texts and the probabilities of their languages."""
    words = Words(data, offsets)
    return words, field.marginals(field.emissions(*features(words, data)), *chains(words.offsets))[0]


def predicted(docs: DataFrame, field: Field | None, columns: list[str], text: str = "text") -> DataFrame:
    """The columns named, with ``lang_pred`` and ``score`` of the text."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if field is None:
        return docs.select(*columns, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(field)
    asked = docs.select(*columns, *([] if text in columns else [text]), letters.alias("__letters"))
    at, kept, n = asked.columns.index(text), docs.select(columns).schema, len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = np.array([*known.languages, "und"], object)
        for batch in batches:
            score, best = np.zeros(batch.num_rows), np.full(batch.num_rows, len(known.languages))
            for lo, hi, data, offsets in chunks(batch.column(at)):
                words, found = word_marginals(known, data, offsets)
                if not len(found):
                    continue
                letter = np.add.reduceat(_LETTER[data] & ~BLANK[data], words.start, dtype=np.int64) > 0
                row = rows_of(words.offsets)[letter]
                sums = np.stack([np.bincount(row, found[letter, i], hi - lo) for i in range(found.shape[1])], axis=1)
                of_row = np.maximum(np.bincount(row, minlength=hi - lo), 1)
                best[lo:hi], score[lo:hi] = sums.argmax(1), np.clip(sums.max(1) / of_row, 0, 1)
            none = ~batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best[none], score[none] = len(known.languages), 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], pa.array(names[best], pa.string()), pa.array(score)],
                [*kept.names, "lang_pred", "score"],
            )

    schema = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double"]
    return map_batches(asked, run, ", ".join(schema))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    return predicted(rows, fit(rows.filter("NOT held_out")), ["doc_id", "held_out"])


def identified(docs: DataFrame) -> DataFrame:
    """The documents in which a language is found, with the columns they came with.

    Learned from the documents themselves, less those held out. What goes is null, empty or without
    letters; texts in several languages stay, however their words divide between them.
    """
    rows = docs.select("doc_id", "text", "lang").withColumn("__out", held_out(F.col("doc_id")))
    field = fit(rows.filter("NOT __out"))
    names = [f"__c{i}" for i in range(len(docs.columns))]
    renamed = docs.toDF(*names)
    text = names[[c.lower() for c in docs.columns].index("text")]
    return predicted(renamed, field, names, text).filter(F.col("lang_pred") != "und").select(names).toDF(*docs.columns)
