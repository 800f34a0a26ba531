"""Exact top-k search by inner product over buckets of vectors of similar length.

Vectors become integers, are sorted by Euclidean length (norm) and packed into buckets; queries are
packed into blocks. The bucket of the longest vectors gives each query a first threshold: its k-th
best score there. For a bucket whose longest vector has norm m, a query of norm n can only gain
where ``n * m`` reaches the threshold, so whole buckets of short vectors fall away for a block. Within
a bucket the threshold becomes a local cosine threshold, ``threshold / (n * m)``:

* where it is low, vectors are pruned by length: only the bucket's leading ones, whose own norm
  reaches ``threshold / n``, are multiplied;
* where it is high, they are pruned by coordinate: on the query's largest coordinate the unit vectors
  that reach the cosine lie within a known interval, read off the bucket's sorted coordinate.

What remains is verified by exact integer products. A bucket is sent to one place once, and the blocks
that need it are streamed past it, each cut down to the queries that do; a task holds one bucket and one
block. Each pair of block and bucket returns at most k rows a query, of which the best k are kept.

Null vectors, vectors holding null or non-finite components and rows with a null id take no part.
Vectors are compared with those of as many components. Repeated rows are candidates each, and queries
each; a query leaves out its own row only. Fewer than k candidates give as many rows. Sums must stay
below 2**63. An empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import map_batches, map_partitions, written

#: Vectors in a bucket and queries in a block; salts that spread the vectors of one dimension.
BUCKET, BLOCK, SALTS = 4096, 512, 64

#: From this local cosine threshold on, a bucket is pruned by coordinate instead of by length.
COORDINATE = 0.7

PACKED = ("group bigint, dim int, n int, longest double, ids binary, rows binary, vectors binary, norms binary, least binary")


def usable(embedding: str) -> Column:
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(embedding).isNotNull() & F.forall(embedding, sound)


def integers(vectors: DataFrame, scale: float, id_column: str, embedding: str) -> DataFrame:
    """(row, id, v, norm2) of the rows that take part; written, so that ``row`` stays."""
    rows = vectors.where(F.col(id_column).isNotNull() & F.coalesce(usable(embedding), F.lit(False)))
    v = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"), v.alias("v"))
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return written(rows.withColumn("norm2", norm2), "vectors")


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Rows sorted by falling norm, ``size`` at a time in one row; groups are numbered in no special order."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.withColumn("dim", F.size("v")).repartitionByRange(n, "dim", F.desc("norm2"), "row")
    dealt = dealt.sortWithinPartitions("dim", F.desc("norm2"), "row").withColumn("part", F.spark_partition_id())
    dealt = dealt.select("part", "dim", "row", "id", "norm2", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held = 0, None
        for batch in [*batches_of(batches), None]:
            if held is not None and (batch is None or batch["dim"][0] != held["dim"][0]):
                while len(held["id"]):
                    yield pack(groups, held, size)
                    groups, held = groups + 1, {k: x[size:] for k, x in held.items()}
                held = None
            if batch is None:
                return
            held = batch if held is None else {k: np.concatenate([held[k], batch[k]]) for k in held}
            while len(held["id"]) > size:
                yield pack(groups, held, size)
                groups, held = groups + 1, {k: x[size:] for k, x in held.items()}

    return written(map_partitions(dealt, run, PACKED), "packed")


def batches_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Numpy columns of the rows, those of one dimension at a time."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            some = batch.filter(pa.array(dims == dim))
            values = some.column("v").flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, dim)
            yield {k: some.column(k).to_numpy(zero_copy_only=False) for k in ("part", "dim", "row", "id", "norm2")} | {"v": values}


def pack(number: int, held: dict, size: int) -> pa.RecordBatch:
    some = {k: x[:size] for k, x in held.items()}
    norms = np.sqrt(some["norm2"])
    group = (int(some["part"][0]) << 32) + number
    row = [group, int(some["dim"][0]), len(norms), float(norms.max()), some["id"].astype("<i8").tobytes(),
           some["row"].astype("<i8").tobytes(), some["v"].astype("<i8").tobytes(), norms.astype("<f8").tobytes(), b""]
    names = [f.split()[0] for f in PACKED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names)


def unpack(group: dict) -> tuple[np.ndarray, ...]:
    vectors = np.frombuffer(group["vectors"], "<i8").reshape(group["n"], group["dim"])
    return (np.frombuffer(group["ids"], "<i8"), np.frombuffer(group["rows"], "<i8"), vectors, np.frombuffer(group["norms"], "<f8"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products; through doubles where these hold every sum."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype("f8") @ b.astype("f8").T).astype("i8")
    return a @ b.T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= kth)
        return some[np.lexsort((ids[some], -scores[some]))][:k]
    return np.lexsort((ids, -scores))


def needing(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Blocks with only those queries whose threshold a bucket's longest vector (``reach``) can meet."""
    for row in batch.to_pylist():
        least, norms = np.frombuffer(row["least"], "<i8"), np.frombuffer(row["norms"], "<f8")
        reach = norms * row["reach"]
        alive = least <= reach + 1e-9 * (1 + reach)
        if not alive.any():
            continue
        some = {f: np.frombuffer(row[f], "<i8")[alive].tobytes() for f in ("ids", "rows", "least")}
        some |= {"vectors": np.frombuffer(row["vectors"], "<i8").reshape(row["n"], row["dim"])[alive].tobytes(), "norms": norms[alive].tobytes(),
                 "n": int(alive.sum()), "longest": float(norms[alive].max())}
        row = {"bucket": row["bucket"], "group": row["group"], "dim": row["dim"]} | some
        names = ["bucket", *[f.split()[0] for f in PACKED.split(", ")]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array([row[x]], kind) for x, kind in zip(names, kinds)], names)


def first_thresholds(block: dict, bucket: dict, k: int) -> np.ndarray:
    """Each query's k-th best score in a bucket, its own row left out; the lowest number if there are fewer."""
    _, q_rows, q, _ = unpack(block)
    _, rows, vectors, _ = unpack(bucket)
    low = np.full(len(q), np.iinfo("i8").min)
    if len(rows) <= k:
        return low
    scores = products(q, vectors)
    scores[q_rows[:, None] == rows[None, :]] = np.iinfo("i8").min
    return np.partition(scores, len(rows) - k, axis=1)[:, len(rows) - k]


def search(block: dict, bucket: dict, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place of the query, ids, scores): the best of a bucket that reach the query's threshold."""
    _, q_rows, q, q_norms = unpack(block)
    ids, rows, vectors, norms = unpack(bucket)
    least = np.frombuffer(block["least"], "<i8")
    reach = q_norms * bucket["longest"]
    slack = 1e-9 * (1 + reach)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(reach > 0, least / reach, -1.0)
    alive = least <= reach + slack
    by_coordinate = alive & (cosine >= COORDINATE)
    by_length = np.flatnonzero(alive & ~by_coordinate)
    if len(by_length):
        shortest = np.where(least[by_length] > 0, least[by_length] / np.maximum(q_norms[by_length], 1e-300), 0.0).min()
        n = int(np.searchsorted(-norms, -shortest * (1 - 1e-9), "right"))  # norms fall
        scores = products(q[by_length], vectors[:n])
        for at, row in zip(by_length, scores):
            some = np.flatnonzero((row >= least[at]) & (rows[:n] != q_rows[at]))
            some = some[best(row[some], ids[some], k)]
            if len(some):
                yield at, ids[some], row[some]
    if by_coordinate.any():
        unit = vectors / np.maximum(norms, 1e-300)[:, None]
        order = {}
        for at in np.flatnonzero(by_coordinate):
            focus = int(np.abs(q[at]).argmax())
            if focus not in order:
                o = unit[:, focus].argsort()
                order[focus] = o, unit[o, focus]
            o, sorted_units = order[focus]
            x, c = q[at, focus] / q_norms[at], min(cosine[at], 1.0)
            wide = np.sqrt((1 - c * c) * max(0.0, 1 - x * x))
            # cosines from c to 1: the interval's end where the unit query itself lies outside it
            low, high = np.searchsorted(sorted_units, [-2.0 if -x >= c else x * c - wide - 1e-9, 2.0 if x >= c else x * c + wide + 1e-9])
            some = o[low:high]
            some = some[rows[some] != q_rows[at]]
            scores = products(q[at:at + 1], vectors[some])[0]
            keep = scores >= least[at]
            some, scores = some[keep], scores[keep]
            top = best(scores, ids[some], k)
            if len(top):
                yield at, ids[some[top]], scores[top]


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: float = 64.0, id_column: str = "vec_id",
          embedding: str = "embedding", bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``queries`` (over ``id``) selects, the k best others."""
    rows = integers(vectors, scale, id_column, embedding)
    buckets = packed(rows, bucket)
    blocks = packed(rows.where(queries), block)

    # One bucket a dimension, of at most ``bucket`` vectors, gives the first thresholds. Blocks meet it, and the
    # heads of all buckets, by dimension and a salt: however many have one dimension, many tasks share them.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    salt = F.pmod(F.xxhash64("group"), F.lit(SALTS)).cast("int").alias("salt")
    first = buckets.groupBy("dim").agg(F.max_by(F.struct(*buckets.columns), F.struct("longest", F.col("n"), -F.col("group"))).alias("b"))
    first = first.select("dim", "b", salts)

    def thresholds(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in batch.to_pylist():
            least = first_thresholds(row["q"], row["b"], k)
            norms = np.frombuffer(row["q"]["norms"], "<f8")
            with np.errstate(divide="ignore", invalid="ignore"):
                needs = np.where(least <= 0, 0.0, least / norms).min()
            yield pa.RecordBatch.from_arrays([pa.array([row["q"]["group"]]), pa.array([least.astype("<i8").tobytes()]),
                                              pa.array([float(needs) * (1 - 1e-9)])], ["group", "least", "needs"])

    asked = blocks.select("dim", salt, F.struct(*blocks.columns).alias("q")).join(first, ["dim", "salt"]).select("q", "b")
    known = written(map_batches(asked, thresholds, "group bigint, least binary, needs double"), "thresholds")
    blocks = written(blocks.drop("least").join(known, "group"), "blocks")
    # Which bucket each block needs: two numbers for each of either, for which no product is made yet.
    heads = buckets.select(F.col("group").alias("bucket"), "dim", "longest", salts)
    pairs = blocks.select("group", "dim", "needs", salt).join(heads, ["dim", "salt"]).where(F.col("longest") >= F.col("needs"))
    pairs = pairs.select("group", "bucket", F.col("longest").alias("reach"))
    fields = [f.split()[0] for f in PACKED.split(", ")]
    # A bucket goes to one place, once; the blocks that need it follow, each with the queries that do.
    sent = pairs.join(blocks.select(*fields), "group").select("bucket", "reach", *fields)
    sent = map_batches(sent, needing, f"bucket bigint, {PACKED}")
    work = buckets.select(F.col("group").alias("bucket"), *fields).withColumn("kind", F.lit(0))
    work = work.unionByName(sent.withColumn("kind", F.lit(1)))
    work = work.repartition("bucket").sortWithinPartitions("bucket", "kind").select("bucket", "kind", *fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["kind"] == 0:
                    held = row
                    continue
                q_ids, q_rows, _, _ = unpack(row)
                found = list(search(row, held, k))
                if found:
                    sizes = [len(f[1]) for f in found]
                    at_query = np.repeat([f[0] for f in found], sizes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_rows[at_query]), pa.array(q_ids[at_query]), pa.array(np.concatenate([f[1] for f in found])),
                         pa.array(np.concatenate([f[2] for f in found]))], ["row", "query_id", "vec_id", "score"])

    found = map_partitions(work, run, "row bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
