"""Byte-level BPE: exact encoding in linear time, and decoding.

A text is cut by the tokenizer's pattern into pieces, and each piece is encoded alone. The usual way
merges the lowest-ranked pair again and again. Here the piece's bytes, read as Latin-1 characters, go
once through an Aho-Corasick automaton of the vocabulary, which gives the longest token at every
position. The encoder then walks from the left taking longest tokens. A token may follow another only
if the two, side by side, are what the merges themselves would leave; that compatibility depends on
the two tokens alone and is memoised. Where no token fits, the walk steps back one token and marks
the position as a dead end, so that no position is tried twice. A sequence of which all neighbours
are compatible is the merges' own result, so the ids are exact.

Texts are handled whole. Null text counts as empty and gives no ids. Repeated rows are each encoded. Of
equal pairs in a piece the left one merges first. An empty table gives no rows. Only the id and the text
are read, whatever other columns there are.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import Chunked, Memo
from .common import add_columns, held, map_batches, text_or_empty

#: Compatible pairs and pieces kept by a worker; beyond that the oldest are computed anew.
PAIRS, PIECES = 300_000, 150_000


class ByteBPE:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.pieces_of = regex.compile(pattern).findall
        self.chunks = Chunked(self._chunk)
        self.piece_ids = Memo(self._piece, PIECES)
        self.compatible: dict[int, bool] = {}
        self.many = max(ranks.values()) + 1
        self.size = {i: len(t) for t, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.reached = ahocorasick.Automaton()
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            parts = [rank] if len(token) == 1 else self._merge(token, rank)
            if len(token) > 1 and len(parts) == 2:
                self.halves[rank] = (parts[0], parts[1])
                self.merged[parts[0], parts[1]] = rank
            if len(token) == 1 or len(parts) == 2:  # else the merges never make this token
                self.reached.add_word(token.decode("latin-1"), (rank, len(token) - 1))
        self.reached.make_automaton()
        self.shorter: dict[int, int | None] = {}

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBPE:
        return cls(ranks_of(path), pattern)

    def _merge(self, token: bytes, below: int) -> list[int]:
        """The merges themselves, with ranks under ``below`` only."""
        ranks, parts = self.ranks, [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def _fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` apart when they stand side by side.

        Undo the latest merge of the two, step by step: they are not left apart if at some step
        the parts that touch would have merged earlier than the merge just undone.
        """
        a, b, undone = left, right, len(self.ranks) + 256
        fits = True
        while True:
            rank = self.merged.get((a, b))
            if rank is not None and rank < undone:
                fits = False
                break
            # of equal ranks the left one merges first
            if a > b and a in self.halves or b not in self.halves:
                if a not in self.halves:
                    break
                undone, a = a, self.halves[a][1]
            else:
                undone, b = b + 1, self.halves[b][0]
        if len(self.compatible) >= PAIRS:
            self.compatible.clear()
        self.compatible[left * self.many + right] = fits
        return fits

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        if token not in self.shorter:
            text = self.token[token].decode("latin-1")
            self.shorter[token] = next(
                (self.reached.get(text[:n])[0] for n in range(len(text) - 1, 0, -1) if text[:n] in self.reached), None)
        return self.shorter[token]

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        n = len(data)
        longest = [0] * n
        for end, (rank, before) in self.reached.iter(data.decode("latin-1")):
            longest[end - before] = rank  # matches come by their ends: the last one is the longest
        alive = bytearray(b"\x01") * (n + 1)
        size, many, known, shorter = self.size, self.many, self.compatible.get, self.shorter
        candidate: int | None = longest[0]
        pos = size[candidate]
        ids, last = [candidate], candidate
        while pos < n:
            candidate, base = longest[pos], last * many
            while candidate is not None:
                end = pos + size[candidate]
                if alive[end]:
                    fits = known(base + candidate)
                    if fits or fits is None and self._fits(last, candidate):
                        break
                candidate = shorter[candidate] if candidate in shorter else self._next_shorter(candidate)
            while candidate is None:  # nothing fits here: a shorter token in the place of the last one
                alive[pos] = 0
                wrong = ids.pop()
                pos -= size[wrong]
                candidate = self._next_shorter(wrong)
                while candidate is not None:
                    end = pos + size[candidate]
                    if alive[end] and (not ids or self._fits(ids[-1], candidate)):
                        break
                    candidate = self._next_shorter(candidate)
            ids.append(candidate)
            last, pos = candidate, end
        return array("I", ids).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.piece_ids.__getitem__, self.pieces_of(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(self.chunks.of(text))

    def decode(self, ids: bytes) -> bytes:
        return joined(self.token, ids)


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def loaded(path: str, pattern: str) -> ByteBPE:
    """The worker's encoder for a rank file, built once as long as the worker encodes."""
    return held((path, pattern), lambda: ByteBPE(ranks_of(path), pattern))


def joined(token: dict[int, bytes], ids: bytes) -> bytes:
    """The bytes of ids."""
    return b"".join(map(token.__getitem__, memoryview(ids).cast("I").tolist()))


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id",
           text_column: str = "text") -> DataFrame:
    """Ids of every whole text: (id, ``token_ids`` binary of little-endian unsigned 32-bit integers).

    ``path`` must be readable by the workers, as an installed package or a shipped file is.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        ids = pa.array([bpe.encode(t) for t in batch.column(1).to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "token_ids"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    return map_batches(rows, run, f"id {kind}, token_ids binary", keeps="byte_bpe").withColumnRenamed("id", id_column)


def decode(ids: DataFrame, path: str, pattern: str, ids_column: str = "token_ids") -> DataFrame:
    """Add ``decoded``, the bytes of the ids, to the rows; a null id list stays null."""
    def run(column: pa.Array) -> list[pa.Array]:
        token = held(("decode", path), lambda: {i: t for t, i in ranks_of(path).items()})
        return [pa.array([None if x is None else joined(token, x) for x in column.to_pylist()], pa.binary())]

    return add_columns(ids, [ids_column], run, "decoded binary", keeps="byte_bpe_decode")


def digests(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the number of ids, the digest of the ids and that of the bytes decoded from them.

    A text is encoded and its ids decoded in one worker, so that a task needs one vocabulary only.
    """
    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path, pattern)
        ids = [bpe.encode(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([sha256(x).hexdigest() for x in ids]),
             pa.array([sha256(bpe.decode(x)).hexdigest() for x in ids])], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text"))
    out = map_batches(rows, run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", keeps="byte_bpe")
    return out.withColumnRenamed("id", id_column)
