"""Helpers shared by the corpus operators.

Working tables go to the shared folder the session names
(:func:`fieldbook.session.work_root`); nothing is kept on a machine's own disk.
"""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldbook.session import work_root

#: Rows that a Python worker handles at a time.
ROWS = 1000

#: A word: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster the package is installed or sent with ``--py-files``; then this adds nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))


#: What a worker keeps from task to task, such as a vocabulary's tables and memos.
HELD: dict = {}


def release() -> None:
    """Give up what is kept, if there is anything, and hand the memory back."""
    if HELD:
        HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        give_back()


def give_back() -> None:
    """Return freed memory to the system where the C library can (glibc)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                   schema: str, keeps: str = "") -> DataFrame:
    """Apply ``fn`` to the Arrow batches of each partition (no shuffle).

    A worker that comes from another operator first gives up what it kept there. ``keeps`` names what this
    one goes on with.
    """
    on_workers(df.sparkSession)

    def run(batches):
        if not keeps or HELD.get("for") != keeps:
            release()
        if keeps:
            HELD["for"] = keeps
        yield from fn(batches)

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
                schema: str, keeps: str = "") -> DataFrame:
    """Apply ``fn`` to each Arrow batch of each partition, ``ROWS`` rows at a time (see :func:`map_partitions`)."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                yield from fn(batch.slice(at, ROWS))

    return map_partitions(df, run, schema, keeps)


def held(key: object, make: Callable[[], object]) -> object:
    """What the worker keeps under a key, made when it isn't there."""
    if key not in HELD:
        HELD[key] = make()
    return HELD[key]


def written(df: DataFrame, tag: str, fmt: str = "parquet") -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts lineage and survives lost executors."""
    path = f"{work_root(df.sparkSession)}/llm/{tag}-{uuid.uuid4().hex}"
    df.write.format(fmt).save(path)
    return df.sparkSession.read.schema(df.schema).format(fmt).load(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def add_columns(df: DataFrame, inputs: list[str], fn: Callable[..., list[pa.Array]], schema: str,
                keeps: str = "") -> DataFrame:
    """Add the columns of ``schema``, made by ``fn`` from Arrow arrays of ``inputs``, to every row.

    Columns already there under one of the new names give way to them.
    """
    new = [part.split()[0] for part in schema.split(", ")]
    kept = [k for k, c in enumerate(df.columns) if c.lower() not in new]
    places = [df.columns.index(c) for c in inputs]
    needed = sorted({*kept, *places})
    slots = {k: f"c{k}" for k in needed}
    fields = df.schema.fields
    rows = df.toDF(*[f"c{k}" for k in range(len(fields))]).select(*slots.values())

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = fn(*[batch.column(needed.index(k)) for k in places])
        yield pa.RecordBatch.from_arrays([*[batch.column(needed.index(k)) for k in kept], *made],
                                         [*[slots[k] for k in kept], *new])

    types = ", ".join(f"{slots[k]} {fields[k].dataType.simpleString()}" for k in kept)
    return map_batches(rows, run, f"{types}, {schema}", keeps).toDF(*[fields[k].name for k in kept], *new)


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """Add ``at``, the place of each row (from 0) in the given order, without bringing rows together.

    Rows are sorted over all partitions and written; a row's place is its place in its partition
    and the number of rows in the partitions before, a table of one row a partition.
    """
    rows = written(df.orderBy(*order).withColumn("part", F.spark_partition_id()).withColumn(
        "within", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "in-order")
    before = rows.groupBy("part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("part", F.coalesce("before", F.lit(0)).alias("before"))
    return rows.join(before, "part").withColumn("at", F.col("before") + F.col("within")).drop("part", "within", "before")
