"""Byte-level BPE by backtracking: the ids that merging in order of rank gives, in linear time.

A rank file lists the tokens as bytes, their ranks being their ids. Merging the two neighbours whose
joined bytes have the lowest rank, again and again, gives one particular row of tokens. Two facts
lead to it without merging. A row is that of the merges if each two neighbours are *compatible*, that
is, if merging the bytes of the pair alone gives the pair again; and of two rows of compatible
neighbours that begin alike, the merges never take one that stops at a dead end. So the longest token
is taken at each place, the next shorter one where it does not go with the token before, and where
none does the token before is taken back and its end is marked as dead, never to be tried again.

Tokens are looked up in the automaton of pyahocorasick, over bytes read as Latin-1 characters. Whether two
tokens are compatible is asked by undoing their last merges, the later one first: the pair falls
where bytes across the border would have been merged before. Answers are memoised, and so are the
pieces of texts, which repeat; both memos are emptied when full, so memory does not grow with the
input. A piece that is itself a token is that token, as in the library whose ids these are; tokens
that merging never makes are found in no other way.

Cases: a null text is an empty one and has no tokens; texts and single pieces of any length are
encoded whole, a long text piece by piece; equal texts give equal rows; an empty table gives no rows.
``report`` reads ``doc_id`` and ``text``. The operators take any other columns, and ``encoded`` keeps
them; its own column replaces one of the same name.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillroll.llm.base import map_batches

#: Entries that a worker remembers: pieces, and pairs of tokens. Forgetting changes no result.
PIECES = 250_000
PAIRS = 1_000_000
#: Longer texts are cut into pieces one at a time, longer pieces are not remembered.
LONG_TEXT = 1 << 20
LONG_PIECE = 64


def read_ranks(path: str) -> bytes:
    """A rank file as it is, each line a token in base 64 and its rank; read on the driver."""
    with open(path, "rb") as file:
        return file.read()


class Bpe:
    """The tokens of a rank file, how each is merged, and the automaton that finds them."""

    def __init__(self, ranks: bytes):
        import ahocorasick

        lines = (line.split() for line in ranks.splitlines() if line.strip())
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.rank.items()}
        self.text_rank = {token.decode("latin-1"): rank for token, rank in self.rank.items()}
        self.compatible: dict[tuple[int, int], bool] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.shorter = [-1] * (max(self.tokens) + 1)
        self.size = [len(self.tokens.get(rank, b"")) for rank in range(len(self.shorter))]
        self._split_all()
        self.automaton = ahocorasick.Automaton()
        for rank in self.parts:
            self.automaton.add_word(self.tokens[rank].decode("latin-1"), rank)
        self.most = max(map(len, self.rank))

    def _split_all(self) -> None:
        """The last merge of each token that merging makes, a byte being its own two parts."""
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            made = [rank] if len(token) == 1 else self._merged(token)
            if len(made) <= 2:
                self.parts[rank] = (made[0], made[-1])
        for rank in self.parts:
            token = self.tokens[rank]
            starts = (self.rank.get(token[:end]) for end in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((r for r in starts if r in self.parts), -1)

    def _merged(self, token: bytes) -> list[int]:
        """Merge a token's bytes by rank, up to the merge that would make the token itself."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [self.rank.get(a + b, len(self.size)) for a, b in zip(parts, parts[1:])]
            at = min(range(len(joined)), key=joined.__getitem__)
            if parts[at] + parts[at + 1] not in self.rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def _goes_with(self, left: int, right: int) -> bool:
        """Whether merging the bytes of two tokens gives the two again."""
        before = 1 << 62  # merges across the border count if they come before the one undone last
        while True:
            across = self.rank.get(self.tokens[left] + self.tokens[right])
            if across is not None and across < before:
                return False
            whole_left, whole_right = self.size[left] == 1, self.size[right] == 1
            if whole_left and whole_right:
                return True
            # Of equal ranks the left one is merged first, so the right one is undone first, and
            # one across the border comes before it.
            if whole_right or (left > right and not whole_left):
                before, left = left, self.parts[left][1]
            else:
                before, right = right + 1, self.parts[right][0]

    def longest(self, piece: str, at: int) -> int:
        """The longest token at a place, -1 at the end."""
        ahead = piece[at : at + self.most]
        reach = self.automaton.longest_prefix(ahead)  # as far as some token goes along
        while reach:
            token = self.automaton.get(ahead[:reach], -1)
            if token >= 0:
                return token
            reach -= 1
        return -1

    def encode(self, piece: str) -> list[int]:
        """The ids of one piece, bytes read as Latin-1."""
        whole = self.text_rank.get(piece)
        if whole is not None:
            return [whole]
        n, size, shorter, compatible, longest = len(piece), self.size, self.shorter, self.compatible, self.longest
        dead, taken, at, token, last = bytearray(n + 1), [], 0, longest(piece, 0), -1
        while at < n:
            while token >= 0:
                end = at + size[token]
                if not dead[end]:
                    if last < 0:
                        break
                    fits = compatible.get((last, token))
                    if fits is None:
                        if len(compatible) >= PAIRS:
                            compatible.clear()
                        fits = compatible[last, token] = self._goes_with(last, token)
                    if fits:
                        break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                last, at = token, end
                token = longest(piece, at)
            elif last < 0:
                raise ValueError("the ranks lack a byte")
            else:
                dead[at] = 1
                token = taken.pop()
                at -= size[token]
                last = taken[-1] if taken else -1
        return taken


@lru_cache(maxsize=2)
def _bpe(ranks: bytes) -> Bpe:
    return Bpe(ranks)


class Encoder:
    """Cuts texts into pieces by a pattern and encodes these, remembering short ones."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        self.bpe, self.pattern = _bpe(ranks), regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        ids = self.known.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                ids = numbered(self.bpe.encode(piece if piece.isascii() else piece.encode().decode("latin-1")))
            if len(piece) <= LONG_PIECE:
                if len(self.known) >= PIECES:  # what was not asked for since the last time is forgotten
                    self.older, self.known = self.known, {}
                self.known[piece] = ids
        return ids

    def blocks(self, text: str) -> Iterator[bytes]:
        """The ids of a text, a long one in blocks."""
        if len(text) <= LONG_TEXT:
            yield b"".join(map(self.piece, self.pattern.findall(text)))
            return
        block: list[bytes] = []
        for n, match in enumerate(self.pattern.finditer(text)):
            block.append(self.piece(match[0]))
            if n % 100_000 == 99_999:
                yield b"".join(block)
                block.clear()
        yield b"".join(block)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bpe.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def numbered(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids) if len(ids) <= LONG_PIECE else np.array(ids, "<u4").tobytes()


def _shared_ranks(spark: SparkSession, path: str):
    """The rank file, a fixed table of a few hundred kB, where every task finds it."""
    return spark.sparkContext.broadcast(read_ranks(path))


def report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: number of tokens, the digest of their ids, and of the bytes decoded from them."""
    ranks = _shared_ranks(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                n, ids_digest, bytes_digest = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encoder.blocks(text.as_py() or ""):
                    n += len(ids) // 4
                    ids_digest.update(ids)
                    bytes_digest.update(encoder.decode(ids))
                rows.append((n, ids_digest.hexdigest(), bytes_digest.hexdigest()))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(n, t()) for n, t in _REPORT.items())])
    return map_batches(docs.select("doc_id", "text"), run, schema)


_REPORT = {"n_tokens": T.LongType, "ids_sha256": T.StringType, "decoded_sha256": T.StringType}


def encoded(docs: DataFrame, path: str, pattern: str, name: str = "ids") -> DataFrame:
    """The documents with their ids, an array of int."""
    ranks, kept = _shared_ranks(docs.sparkSession, path), [c for c in docs.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            ids = [np.frombuffer(b"".join(encoder.blocks(t.as_py() or "")), "<u4").astype("i4") for t in batch.column("text")]
            columns = [*(batch.column(c) for c in kept), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, name])

    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, T.ArrayType(T.IntegerType()))])
    return map_batches(docs.select(*kept), run, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", name: str = "text") -> DataFrame:
    """Rows with the text of their ids; bytes that are no text become replacement characters."""
    ranks, kept = _shared_ranks(rows.sparkSession, path), [c for c in rows.columns if c != name]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _bpe(ranks.value).tokens
        for batch in batches:
            texts = [None if v is None else b"".join(map(tokens.__getitem__, v)).decode("utf-8", "replace") for v in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(texts, pa.string())], names=[*kept, name])

    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(name, T.StringType())])
    return map_batches(rows.select(*kept), run, schema)
