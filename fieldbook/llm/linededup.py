r"""Line dedup that can be undone: sharded cuckoo filters backed by exact reference counts.

A document's lines are known by their keys: ASCII white space stripped at both ends, A-Z lower-cased, at
least ``least_chars`` code points. A key is stored as a 128-bit digest. A :class:`LineIndex` keeps, in the
shared folder,

* *references*: which document holds which key, and in how many lines;
* *counts*: for each key the exact number of documents that hold it and the least of their ids;
* *filters*: for each shard of the keys a cuckoo filter that holds a key's 16-bit fingerprint once where one
  document holds the key, twice where two or more do.

``insert`` asks the filters first: a key they don't know is new, and needs no look at the counts. Only what
they may know is joined with the counts. ``delete`` takes a document's references back: its keys are counted
anew, the least id included, and fingerprints leave the filters as counts fall below two and one; so lines
that were dropped in favour of a deleted document come back. ``dedup`` drops lines: a key with fewer than two
fingerprints is in one document only and its lines stay; for the others the exact counts decide.

Shards follow from the number of keys, ``KEYS`` to a shard. A shard's changes are one row a key, however
many documents hold it: references are added up by key before they are dealt out. Every change writes new
folders and, last of all, one row that names them; a run that dies leaves the index as it was, and
:meth:`LineIndex.open` finds the latest state. Nothing but counts reaches the driver.

Null text is one empty line. Rows with one id are one document. A null id is a document of its own, behind
all others. Repeated rows get the same result each. An empty table gives no rows. Other columns of the input
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldbook.session import work_root

from .common import map_batches, on_workers, text_or_empty, written

#: Code points of the shortest key that counts; keys to a shard; salts that spread the references of one key.
LEAST_CHARS, KEYS, SALTS = 10, 1 << 16, 16

#: Slots in a bucket; share of the slots to be filled at first; rounds of moves before another table is added.
SLOTS, LOAD, ROUNDS = 4, 0.6, 64

WHITE = b" \t\n\x0b\x0c\r"
KEY = ["k1", "k2"]


class Cuckoo:
    """A cuckoo filter: tables of buckets of 16-bit fingerprints, changed and asked many keys at a time.

    A fingerprint lies in one of two buckets, each told by the other and the fingerprint. A key may be put
    in more than once. Where the moves find no room, a further table with the same buckets is added.
    """

    def __init__(self, tables: np.ndarray):
        self.tables = tables  # (table, bucket, slot)

    @classmethod
    def sized(cls, keys: int) -> Cuckoo:
        buckets = max(2, 1 << int(np.ceil(np.log2(max(1, keys) / (SLOTS * LOAD) + 1))))
        return cls(np.zeros((1, buckets, SLOTS), np.uint16))

    @classmethod
    def from_bytes(cls, buckets: int, data: bytes) -> Cuckoo:
        return cls(np.frombuffer(data, "<u2").reshape(-1, buckets, SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.tables.astype("<u2").tobytes()

    @property
    def buckets(self) -> int:
        return self.tables.shape[1]

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, one of its two buckets) of 64-bit keys."""
        keys = keys.view(np.uint64)
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1  # 0 is an empty slot
        return prints, (keys & np.uint64(self.buckets - 1)).astype(np.int64)

    def other(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        step = (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
        return bucket ^ ((step & np.uint64(self.buckets - 1)) | np.uint64(1)).astype(np.int64)

    def _settle(self, prints: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Fill free slots of the last table; returns which fingerprints found no room."""
        table = self.tables[-1]
        order = np.argsort(bucket, kind="stable")
        at = bucket[order]
        first = np.r_[True, at[1:] != at[:-1]]
        rank = np.arange(len(at)) - np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        free = table[at] == 0
        room = rank < free.sum(1)
        slot = (np.cumsum(free, 1) == (rank + 1)[:, None]).argmax(1)
        table[at[room], slot[room]] = prints[order][room]
        left = np.zeros(len(at), bool)
        left[order[~room]] = True
        return left

    def add(self, keys: np.ndarray) -> None:
        prints, bucket = self.places(keys)
        turn = 0
        while len(prints):
            for _ in range(2):
                left = self._settle(prints, bucket)
                prints, bucket = prints[left], bucket[left]
                if not len(prints):
                    return
                bucket = self.other(prints, bucket)
            turn += 1
            if turn % ROUNDS == 0:
                self.tables = np.concatenate([self.tables, np.zeros_like(self.tables[:1])])
                continue
            # one of those waiting at a bucket takes a slot; what lay there goes to its other bucket
            _, who = np.unique(bucket, return_index=True)
            where, slot, table = bucket[who], (turn + who) % SLOTS, self.tables[-1]
            out = table[where, slot].copy()
            table[where, slot] = prints[who]
            prints[who], bucket[who] = out, self.other(out, where)

    def _found(self, prints: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Both buckets of each fingerprint, the lesser first, and which of their slots in all tables hold it."""
        other = self.other(prints, bucket)
        low, high = np.minimum(bucket, other), np.maximum(bucket, other)
        held = np.concatenate([t[b] for t in self.tables for b in (low, high)], axis=1)
        return low, high, held == prints[:, None]

    def count(self, keys: np.ndarray) -> np.ndarray:
        """How many fingerprints like each key's there are: never fewer than its own."""
        return self._found(*self.places(keys))[2].sum(1) if len(keys) else np.zeros(0, np.int64)

    def remove(self, keys: np.ndarray) -> None:
        """Take one fingerprint of each key out; a key listed twice loses two."""
        if not len(keys):
            return
        prints, bucket = self.places(keys)
        low, high, held = self._found(prints, bucket)
        order = np.lexsort((prints, low))
        same = np.r_[False, (low[order][1:] == low[order][:-1]) & (prints[order][1:] == prints[order][:-1])]
        run = np.arange(len(order))
        rank = np.empty(len(order), np.int64)
        rank[order] = run - np.maximum.accumulate(np.where(same, 0, run))
        hit = (np.cumsum(held, 1) == (rank + 1)[:, None]) & held
        if not hit.any(1).all():
            raise ValueError("a key to remove is not in the filter")
        column = hit.argmax(1)
        table, column = column // (2 * SLOTS), column % (2 * SLOTS)
        self.tables[table, np.where(column < SLOTS, low, high), column % SLOTS] = 0


def line_keys(text: bytes, least_chars: int) -> list[bytes | None]:
    """The digest of each line's key; None for lines too short to count."""
    out = []
    for line in text.split(b"\n"):
        key = line.strip(WHITE).lower()
        n = len(key)
        counts = n >= least_chars and (n >= 4 * least_chars or len(key.decode()) >= least_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if counts else None)
    return out


def references(docs: DataFrame, least_chars: int, id_column: str, text_column: str) -> DataFrame:
    """(k1, k2, doc, h, n): a row for each key of each text, ``h`` a hash of the text, ``n`` its lines."""
    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("doc"), text_or_empty(text_column).alias("text"))
    rows = rows.select("doc", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        digests, rows, lines = [], [], []
        for at, text in enumerate(batch.column(2).to_pylist()):
            found: dict[bytes, int] = {}
            for key in line_keys(text, least_chars):
                if key is not None:
                    found[key] = found.get(key, 0) + 1
            digests += found
            rows += [at] * len(found)
            lines += found.values()
        both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), batch.column(0).take(taken), batch.column(1).take(taken),
             pa.array(lines, pa.int32())], ["k1", "k2", "doc", "h", "n"])

    return map_batches(rows, run, f"k1 bigint, k2 bigint, doc {kind}, h bigint, n int")


class LineIndex:
    """Which documents hold which lines, kept in a shared folder; see the module."""

    def __init__(self, spark: SparkSession, path: str, states: list[dict], id_type: str, least_chars: int):
        self.spark, self.path, self.states, self.id_type, self.least_chars = spark, path, states, id_type, least_chars

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, id_type: str = "bigint",
               least_chars: int = LEAST_CHARS) -> LineIndex:
        """An empty index."""
        return cls(spark, path or f"{work_root(spark)}/llm/lines-{uuid.uuid4().hex}", [], id_type, least_chars)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineIndex:
        """The index as the last finished change left it."""
        rows = [json.loads(r.value) for r in spark.read.text(f"{path}/states").collect()]
        states = sorted(rows, key=lambda s: s["version"])
        return cls(spark, path, states, states[-1]["id_type"], states[-1]["least_chars"])

    # -- what is stored -----------------------------------------------------

    def _read(self, name: str, schema: str, states: list[dict] | None = None) -> DataFrame:
        found = [f"{self.path}/{s['folder']}/{name}" for s in (self.states if states is None else states) if name in s["tables"]]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    @property
    def _reference(self) -> str:
        return f"k1 bigint, k2 bigint, doc {self.id_type}, h bigint, n int, v int"

    @property
    def _count(self) -> str:
        return f"k1 bigint, k2 bigint, n_docs bigint, least {self.id_type}, v int"

    def references(self) -> DataFrame:
        """(k1, k2, doc, n) of the documents that are there."""
        rows = self._read("references", self._reference)
        gone = self._read("deleted", f"doc {self.id_type}, v int").groupBy("doc").agg(F.max("v").alias("gone"))
        gone = gone.withColumnRenamed("doc", "gone_doc")
        live = rows.join(gone, F.col("doc").eqNullSafe(F.col("gone_doc")), "left").where("gone IS NULL OR v > gone")
        return live.groupBy(*KEY, "doc").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        """(k1, k2, n_docs, least): the exact reference counts, of keys that any document holds."""
        return self._latest(self._read("counts", self._count)).where("n_docs > 0")

    @staticmethod
    def _latest(counts: DataFrame) -> DataFrame:
        latest = counts.groupBy(*KEY).agg(F.max_by(F.struct("n_docs", "least"), "v").alias("c"))
        return latest.select(*KEY, "c.n_docs", "c.least")

    def _filters(self) -> DataFrame:
        """(shard, buckets, data) of the last state."""
        return self._read("filters", "shard int, buckets int, data binary", self.states[-1:])

    @property
    def shards(self) -> int:
        return self.states[-1]["shards"] if self.states else 0

    def _shard(self) -> Column:
        return F.pmod(F.col("k1"), F.lit(self.shards)).cast("int").alias("shard")

    # -- the filters --------------------------------------------------------

    def _may_hold(self, keys: DataFrame, copies: int) -> DataFrame:
        """Those of distinct keys that the filters hold ``copies`` times, as far as fingerprints tell."""
        if not self.states:
            return keys.limit(0)
        on_workers(self.spark)

        def ask(held: pa.Table, asked: pa.Table) -> pa.Table:
            if not held.num_rows or not asked.num_rows:
                return asked.select(KEY).slice(0, 0)
            cuckoo = Cuckoo.from_bytes(held["buckets"][0].as_py(), held["data"][0].as_py())
            known = cuckoo.count(asked["k2"].to_numpy()) >= copies
            return asked.select(KEY).filter(pa.array(known))

        asked = keys.select(self._shard(), *KEY)
        return self._filters().groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(ask, "k1 bigint, k2 bigint")

    def _changed_filters(self, changes: DataFrame, shards: int) -> DataFrame:
        """The filters after rows of (k1, k2, more): fingerprints to put in (more > 0) or take out (more < 0)."""
        on_workers(self.spark)

        def change(held: pa.Table, new: pa.Table) -> pa.Table:
            shard = (held if held.num_rows else new)["shard"][0]
            keys, more = new["k2"].to_numpy(), new["more"].to_numpy()
            if held.num_rows:
                cuckoo = Cuckoo.from_bytes(held["buckets"][0].as_py(), held["data"][0].as_py())
            else:
                cuckoo = Cuckoo.sized(max(KEYS, int(more.sum())))
            cuckoo.remove(np.repeat(keys, np.maximum(-more, 0)))
            cuckoo.add(np.repeat(keys, np.maximum(more, 0)))
            return pa.table({"shard": pa.array([shard.as_py()], pa.int32()), "buckets": pa.array([cuckoo.buckets], pa.int32()),
                             "data": pa.array([cuckoo.to_bytes()], pa.binary())})

        old = self._filters() if shards == self.shards else self._filters().limit(0)
        dealt = changes.select(F.pmod(F.col("k1"), F.lit(shards)).cast("int").alias("shard"), *KEY, F.col("more").cast("int").alias("more"))
        return old.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInArrow(change, "shard int, buckets int, data binary")

    # -- changes ------------------------------------------------------------

    def _kept(self, df: DataFrame, folder: str, name: str) -> DataFrame:
        """Write a table of a change and read it back."""
        df.write.parquet(f"{self.path}/{folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}/{name}")

    def _finish(self, folder: str, table: str, changes: DataFrame, n_keys: int) -> LineIndex:
        """Write the counts, the filters by the change of the counts, and last the row that makes all current.

        ``changes`` has (k1, k2, n_docs, least, n_before). Where the keys outgrow their shards, the filters are
        built anew, over more shards, from all counts.
        """
        version = len(self.states) + 1
        self._kept(changes.select(*KEY, "n_docs", "least", F.lit(version).alias("v")), folder, "counts")
        state = {"version": version, "folder": folder, "tables": [table, "counts", "filters"], "n_keys": n_keys,
                 "shards": self.shards, "id_type": self.id_type, "least_chars": self.least_chars}
        copies = lambda n: F.least(F.col(n), F.lit(2))
        if self.shards and n_keys <= 2 * KEYS * self.shards:
            more = changes.select(*KEY, (copies("n_docs") - copies("n_before")).alias("more")).where("more <> 0")
        else:
            state["shards"] = max(1, -(-n_keys // KEYS))
            all_counts = LineIndex(self.spark, self.path, [*self.states, state], self.id_type, self.least_chars).counts()
            more = all_counts.select(*KEY, copies("n_docs").alias("more"))
        self._kept(self._changed_filters(more, state["shards"]), folder, "filters")
        self.spark.range(1, numPartitions=1).select(F.lit(json.dumps(state)).alias("value")).write.mode("append").text(f"{self.path}/states")
        return LineIndex(self.spark, self.path, [*self.states, state], self.id_type, self.least_chars)

    def _n_keys(self) -> int:
        return self.states[-1]["n_keys"] if self.states else 0

    def insert(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> LineIndex:
        """The index with these documents; their ids must be new to it."""
        folder, version = f"insert-{uuid.uuid4().hex}", len(self.states) + 1
        if self.states:
            there = self.references().select(F.col("doc").alias("there")).distinct()
            twice = docs.select(F.col(id_column).alias("doc")).join(there, F.col("doc").eqNullSafe(F.col("there")), "left_semi")
            if not twice.isEmpty():
                raise ValueError("some of these documents are in the index; delete them first")
        new = references(docs, self.least_chars, id_column, text_column).withColumn("v", F.lit(version))
        new = self._kept(new, folder, "references")
        # by document first, which splits a key that many hold; then by key, added up before the shuffle
        counted = new.groupBy(*KEY, "doc").agg(F.lit(1).alias("one")).groupBy(*KEY).agg(
            F.count("*").alias("n_new"), F.min("doc").alias("least_new"))
        counted = self._kept(counted, folder, "counted")
        if self.states:
            seen = self._may_hold(counted, 1)
            old = self._latest(self._read("counts", self._count).join(seen, KEY, "left_semi"))
            counted = counted.join(old, KEY, "left")
        else:
            counted = counted.withColumns({"n_docs": F.lit(0).cast("long"), "least": F.lit(None).cast(self.id_type)})
        before = F.coalesce("n_docs", F.lit(0))
        after = counted.select(*KEY, (F.col("n_new") + before).alias("n_docs"), F.least("least", "least_new").alias("least"),
                               before.alias("n_before"))
        after = self._kept(after, folder, "after")
        fresh = after.where("n_before = 0").count()
        return self._finish(folder, "references", after, self._n_keys() + fresh)

    def delete(self, ids: DataFrame, id_column: str = "doc_id") -> LineIndex:
        """The index without these documents; ids that are not there change nothing."""
        folder = f"delete-{uuid.uuid4().hex}"
        names = ids.select(F.col(id_column).cast(self.id_type).alias("doc")).distinct()
        live = self.references()
        listed = names.withColumnRenamed("doc", "gone_doc")
        gone = live.join(listed, F.col("doc").eqNullSafe(F.col("gone_doc")), "left_semi")
        self._kept(names.withColumn("v", F.lit(len(self.states) + 1)), folder, "deleted")
        touched = self._kept(gone.select(*KEY).distinct(), folder, "touched")
        # what is left of each key: its references are salted, so that one many hold is counted by many tasks
        salted = touched.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        left = live.join(listed, F.col("doc").eqNullSafe(F.col("gone_doc")), "left_anti")
        left = left.withColumn("salt", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).cast("int")).join(salted, [*KEY, "salt"])
        left = left.groupBy(*KEY, "salt").agg(F.count("*").alias("n"), F.min("doc").alias("low"))
        left = left.groupBy(*KEY).agg(F.sum("n").alias("n"), F.min("low").alias("least"))
        before = self._latest(self._read("counts", self._count).join(touched, KEY, "left_semi"))
        before = before.select(*KEY, F.col("n_docs").alias("n_before"))
        after = before.join(left, KEY, "left").select(*KEY, F.coalesce("n", F.lit(0)).alias("n_docs"), "least", "n_before")
        after = self._kept(after, folder, "after")
        lost = after.where("n_docs = 0").count()
        return self._finish(folder, "deleted", after, self._n_keys() - lost)

    # -- use ----------------------------------------------------------------

    def repeated(self, keys: DataFrame) -> DataFrame:
        """Of distinct (k1, k2), those that two documents and more hold, with the least of these as ``owner``."""
        maybe = self._may_hold(keys, 2)
        known = self._latest(self._read("counts", self._count).join(maybe, KEY, "left_semi"))
        return known.where("n_docs > 1").select(*KEY, F.col("least").alias("owner"))

    def dedup(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """(id, ``n_lines``, ``n_dropped``, ``dropped``, ``kept``) of documents that are in the index.

        ``dropped`` lists the places (from 0) of lines that stay in a document of a lesser id only; ``kept``
        is the others joined by new lines.
        """
        own = self._kept(references(docs, self.least_chars, id_column, text_column), f"dedup-{uuid.uuid4().hex}", "references")
        # written, so that the join's sides are plain exchanges, below which a key that many hold is split
        repeated = written(self.repeated(own.select(*KEY).distinct()), "repeated-lines")
        drops = own.join(repeated, KEY).where(~F.col("doc").eqNullSafe(F.col("owner")))
        # by document and text, so that however many rows have one id, a list is no longer than a text's
        drops = drops.groupBy("doc", "h").agg(F.collect_set(F.struct(*KEY)).alias("drop"))
        drops = drops.withColumnsRenamed({"doc": "drop_doc", "h": "drop_h"})
        rows = docs.select(F.col(id_column).alias("doc"), text_or_empty(text_column).alias("text"))
        rows = rows.withColumn("h", F.xxhash64("text"))
        rows = rows.join(drops, F.col("doc").eqNullSafe(F.col("drop_doc")) & (F.col("h") == F.col("drop_h")), "left")
        rows = rows.select("doc", F.col("text").cast("binary").alias("text"), "drop")
        least_chars = self.least_chars

        def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            n_lines, dropped, kept = [], [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if not drop:
                    n_lines.append(text.count(b"\n") + 1)
                    dropped.append([])
                    kept.append(text)
                    continue
                gone = {np.array([d["k1"], d["k2"]], "<i8").tobytes() for d in drop}
                out = [k in gone for k in line_keys(text, least_chars)]
                n_lines.append(len(out))
                dropped.append([at for at, x in enumerate(out) if x])
                kept.append(b"\n".join(line for line, x in zip(text.split(b"\n"), out) if not x))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_lines, pa.int64()), pa.array([len(d) for d in dropped], pa.int64()),
                 pa.array(dropped, pa.list_(pa.int32())), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc", "n_lines", "n_dropped", "dropped", "kept"])

        kind = docs.schema[id_column].dataType.simpleString()
        out = map_batches(rows, cut, f"doc {kind}, n_lines bigint, n_dropped bigint, dropped array<int>, kept string")
        return out.withColumnRenamed("doc", id_column)


def drop_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document without the lines that a document of a lesser id holds too; see :meth:`LineIndex.dedup`."""
    index = LineIndex.create(docs.sparkSession, id_type=docs.schema[id_column].dataType.simpleString(), least_chars=least_chars)
    return index.insert(docs, id_column, text_column).dedup(docs, id_column, text_column)
