"""Repeated passages over a whole corpus, by fixed-window fingerprints partitioned on prefixes.

Passages that occur twice would be the inner nodes of the tree of all suffixes, and passages of
``window`` words its nodes at that depth. No such tree is built, and no suffixes are ordered or
compared: each window of ``window`` words is a fingerprint, and equal ones stand for a node.

* *Prefixes.* Windows are dealt into groups by their leading words. A prefix is one word, or, where
  so many windows start with it that the group would outgrow the others, that word and the next, and so
  on. The prefixes are chosen from a bounded sample; the choice balances the groups and has no part in
  the result. Unless given, the number of groups follows from the size of all texts: ``GROUP_CHARS`` to a
  group.
* *Groups.* A window is known by a 64-bit fingerprint of its words, beneath its prefix; sorting the
  group's fingerprints brings equal ones together, and those there twice or more are repeats.
* *Blocks.* Texts are packed into blocks. A block sends each group the distinct fingerprints it has
  there, once each however often the passage occurs in it, so a passage that is everywhere brings a
  group one entry a block. The group answers with one bit for each entry.

In its block, each word covered by a repeated window is dropped, neighbouring windows joining into
maximal repeated passages.

Words are separated by ASCII white space, unchanged otherwise; windows never cross documents, and are
judged on the input. Words are hashed as wholes (xxh3), passages by polynomials modulo two primes, so no
structure of letters or words makes different ones agree; by chance two different passages count as one
under the same prefix in about one of 10**12 windows for groups of a million. Null text has no words, and its kept text
is empty, as is that of an empty text. Repeated rows repeat all their windows. An empty table gives
no rows. Only the id and the text are read, whatever other columns there are. Memory is some 60 times the
largest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pyarrow.ipc  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import map_partitions, written

#: Text bytes in a block; texts and words sampled for the choice of prefixes; bits of a word's hash that tell prefixes apart.
BLOCK_BYTES, SAMPLE_TEXTS, SAMPLE_WORDS, CELL_BITS = 2 << 20, 2_000, 400_000, 12

#: Any number, the same everywhere.
WORD_BASE = np.uint64(0xD6E8FEB86659FD93)

#: Two primes under 2**31: sequences are hashed modulo each.
PRIMES = (2147483647, 2147483629)

#: Code points of text to a group.
GROUP_CHARS = 8_000_000

SEPARATES = np.zeros(256, bool)
SEPARATES[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo a prime: n of them at least."""
    known = _powers.get((base, prime), np.ones(1, np.uint64))
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), prime)) % np.uint64(prime)])
    _powers[base, prime] = known
    return known


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans_hashed(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for each span, from sums over the whole array.

    Each half of the hash is a polynomial modulo a prime, which different sequences of n values share with
    a chance of n in 2**31 at most, whatever their structure.
    """
    out = np.zeros(len(starts), np.uint64)
    for shift, prime in zip((0, 32), PRIMES):
        p, b = np.uint64(prime), int(base) % prime
        terms = (values >> np.uint64(shift) & np.uint64(0xFFFFFFFF)) % p * powers(b, prime, len(values))[:len(values)] % p
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])  # under 2**31 each
        hashed = (sums[ends] - sums[starts]) % p * powers(pow(b, -1, prime), prime, len(values))[starts] % p
        out |= hashed << np.uint64(shift)
    return mixed(out + (ends - starts).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words_hashed(letters: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each word, given all words' bytes in a row: equal words are found as such, each hashed once."""
    bounds = np.concatenate([[0], np.cumsum(sizes)]).astype("<i8")
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    hashes = np.array([xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return hashes[coded.indices.to_numpy()]


class Words:
    """The words of some texts: where they lie in the joined bytes, and their hashes."""

    def __init__(self, texts: list[str | None]):
        joined = [(t or "").encode() for t in texts]
        self.bytes = np.frombuffer(b"\n".join([*joined, b""]), np.uint8)
        sizes = np.array([len(t) + 1 for t in joined], np.int64)
        text_ends = np.cumsum(sizes)
        inside = ~SEPARATES[self.bytes]
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.hashes = words_hashed(self.bytes[inside], self.ends - self.starts)
        #: The number of words before each text, and in all.
        self.before = np.concatenate([[0], np.searchsorted(self.starts, text_ends)])

    def windows(self, size: int) -> np.ndarray:
        """Places of the words at which a window of so many words starts within a text."""
        at = np.arange(max(0, len(self.starts) - size + 1))
        last = np.searchsorted(self.before, at, "right")
        return at[at + size <= self.before[last]] if len(at) else at

    def kept(self, drop: np.ndarray) -> list[str]:
        """Each text's words but the dropped ones, joined by single spaces."""
        out, starts, ends = self.bytes.copy(), self.starts[~drop], self.ends[~drop]
        out[ends] = 0x20  # a separator follows every word
        mask = np.zeros(len(self.bytes) + 1, np.int8)
        np.add.at(mask, starts, 1)
        np.add.at(mask, ends + 1, -1)
        keep = np.cumsum(mask[:-1], dtype=np.int8).astype(bool)
        counts = np.concatenate([[0], np.cumsum(np.where(drop, 0, self.ends - self.starts + 1))])
        text = out[keep].tobytes()
        bounds = counts[self.before]
        return [text[a:max(a, b - 1)].decode() for a, b in zip(bounds, bounds[1:])]


class Prefixes:
    """Which group a suffix belongs to: a tree of tables by the cells of its first words' hashes."""

    def __init__(self, groups: int):
        self.groups = groups
        self.tables = [np.zeros(1 << CELL_BITS, np.int64)]

    @staticmethod
    def cells(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)

    @classmethod
    def chosen(cls, hashes: np.ndarray, starts: np.ndarray, depth: int, groups: int) -> Prefixes:
        """Prefixes that split the sample's suffixes into groups of like size."""
        made = cls(groups)
        cells, share = cls.cells(hashes), max(1.0, len(starts) / groups)
        todo, filled = [(0, starts, 0)], 0.0
        while todo:
            table, some, level = todo.pop()
            here = cells[some + level]
            counts = np.bincount(here, minlength=1 << CELL_BITS)
            order = np.argsort(here, kind="stable")
            bounds = np.concatenate([[0], np.cumsum(counts)])
            # cells fill one group after the other; what the sample lacks is dealt out evenly
            heavy = (counts > share) & (level + 1 < depth)
            weights = np.where(heavy, 0, counts) + 1e-3
            place = filled + np.cumsum(weights)
            filled = place[-1]
            made.tables[table][:] = (place / share).astype(np.int64) % groups
            for cell in np.flatnonzero(heavy):
                made.tables[table][cell] = -len(made.tables)
                todo.append((len(made.tables), some[order[bounds[cell]:bounds[cell + 1]]], level + 1))
                made.tables.append(np.zeros(1 << CELL_BITS, np.int64))
        return made

    def of(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        cells = self.cells(hashes)
        group = self.tables[0][cells[starts]]
        deeper, level = np.flatnonzero(group < 0), 1
        tables = np.stack(self.tables)
        while len(deeper):
            group[deeper] = tables[-group[deeper], cells[starts[deeper] + level]]
            deeper, level = deeper[group[deeper] < 0], level + 1
        return group


def compressed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def restored(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(block).read_all()


def blocks_of(docs: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """(block, data): whole rows packed together, written."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + size, "right")))
                yield pa.RecordBatch.from_arrays([pa.array([compressed(batch.slice(at, end - at))], pa.binary())], ["data"])
                at = end

    return written(map_partitions(rows, run, "data binary").select(F.monotonically_increasing_id().alias("block"), "data"), "blocks")


def prefixes_for(docs: DataFrame, window: int, groups: int | None, text_column: str) -> Prefixes:
    """Prefixes from a bounded sample: the texts of least hash, each cut at random places only where words begin."""
    share = f"xxhash64({text_column})"
    n, chars = docs.agg(F.count("*"), F.coalesce(F.sum(F.length(text_column)), F.lit(0))).first()
    groups = groups or -(-chars // GROUP_CHARS) or 1
    some = docs.where(F.pmod(F.expr(share), F.lit(1 << 20)) < max(1, round(min(1.0, SAMPLE_TEXTS / max(n, 1)) * (1 << 20))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(batch.column(0).to_pylist())
            at = words.windows(window)
            at = at[mixed(words.hashes[at] + at.astype(np.uint64)) % np.uint64(16) == 0] if len(at) else at
            rows = [words.hashes[a:a + window].astype("<u8").tobytes() for a in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["words"])

    rows = map_partitions(some.select(text_column), run, "words binary").limit(SAMPLE_WORDS // 8).toPandas()["words"]
    hashes = np.frombuffer(b"".join(rows), "<u8")
    return Prefixes.chosen(hashes, np.arange(len(rows)) * window, window, groups)


def fingerprints(words: Words, window: int, prefixes: Prefixes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each group: (group, places, distinct fingerprints, which of them each place has, how many places have it)."""
    at = words.windows(window)
    if not len(at):
        return
    prints = spans_hashed(words.hashes, WORD_BASE, at, at + window)
    group = prefixes.of(words.hashes, at)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(prefixes.groups + 1))
    for g in range(prefixes.groups):
        some = order[bounds[g]:bounds[g + 1]]
        if len(some):
            distinct, which, counts = np.unique(prints[some], return_inverse=True, return_counts=True)
            yield g, at[some], distinct, which, counts


def repeats(table: pa.Table) -> pa.Table:
    """A group's subtree at depth ``window``: for each block's fingerprints, whether another block has them."""
    sizes = [len(x) // 8 for x in table["prints"].to_pylist()]
    prints = np.frombuffer(b"".join(table["prints"].to_pylist()), "<u8")
    order = np.argsort(prints, kind="stable")
    ordered = prints[order]
    same = ordered[1:] == ordered[:-1]
    inner = np.zeros(len(prints), bool)
    inner[order] = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    bits = [np.packbits(x).tobytes() for x in np.split(inner, np.cumsum(sizes)[:-1])]
    return pa.table({"block": table["block"], "group": table["group"], "bits": pa.array(bits, pa.binary())})


def drop_repeats(docs: DataFrame, window: int = 35, groups: int | None = None, block_bytes: int = BLOCK_BYTES,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_words``, ``n_removed``, ``removed``, ``kept``) of every document.

    ``removed`` lists the maximal spans of dropped words (first, end exclusive, from 0); ``kept`` is
    the remaining words joined by single spaces.
    """
    prefixes = prefixes_for(docs, window, groups, text_column)
    blocks = blocks_of(docs, block_bytes, id_column, text_column)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                words = Words(restored(batch.column(1)[k].as_py())["text"].to_pylist())
                block = batch.column(0)[k].as_py()
                found = [(g, distinct.astype("<u8").tobytes()) for g, _, distinct, _, _ in fingerprints(words, window, prefixes)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(found), pa.int64()), pa.array([f[0] for f in found], pa.int32()),
                     pa.array([f[1] for f in found], pa.binary())], ["block", "group", "prints"])

    sent = map_partitions(blocks, send, "block bigint, group int, prints binary")
    answers = sent.groupBy("group").applyInArrow(repeats, "block bigint, group int, bits binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("group", "bits")).alias("answers"))
    both = blocks.join(answers, "block", "left").select("data", "answers")
    kind = docs.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = restored(batch.column(0)[k].as_py())
                words = Words(rows["text"].to_pylist())
                bits = {a["group"]: np.unpackbits(np.frombuffer(a["bits"], np.uint8)) for a in batch.column(1)[k].as_py() or ()}
                change = np.zeros(len(words.starts) + 1, np.int64)
                for g, at, distinct, which, counts in fingerprints(words, window, prefixes):
                    repeated = at[((counts > 1) | bits[g][:len(distinct)].astype(bool))[which]]
                    np.add.at(change, repeated, 1)
                    np.add.at(change, repeated + window, -1)
                drop = np.cumsum(change[:-1]) > 0
                n_drop = np.concatenate([[0], np.cumsum(drop)])[words.before]
                spans = []
                for a, b in zip(words.before, words.before[1:]):
                    edges = np.flatnonzero(np.diff(drop[a:b].view(np.int8), prepend=0, append=0)) if n_drop[-1] else []
                    spans.append([{"first": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])])
                yield pa.RecordBatch.from_arrays(
                    [rows["id"].combine_chunks(), pa.array(np.diff(words.before), pa.int64()), pa.array(np.diff(n_drop), pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                     pa.array(words.kept(drop), pa.string())], ["id", "n_words", "n_removed", "removed", "kept"])

    out = map_partitions(both, cut, f"id {kind}, n_words bigint, n_removed bigint, removed array<struct<first:bigint,end:bigint>>, kept string")
    return out.withColumnRenamed("id", id_column)
