"""Versioned tables: write new versions, then make a run's versions current together.

The survey workflow reads a table (registry, dictionary), changes it and writes it back under the same
name. Spark cannot overwrite a path it is reading from, and an interrupted overwrite would lose the table. So
every version is a folder of its own, never written twice, and one small table of runs says which versions
there are::

    <root>/<table>/v=<version>-<run>/part-*.parquet   (or .csv; below it folders of a partitioned table)
    <root>/_runs/part-*.json    {"run": ..., "table": ..., "version": N, "format": ..., "folder": ..., "partitions": [...]}

A run writes all its versions first; its last step appends one row for each of them to the table of runs, in
one file, which Spark's writer makes visible as a whole. A run that dies before that leaves every table as it
was, and what it wrote is never read. A table's current version is its greatest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.session import work_root
from fieldbook.sources.landing import CSV_OPTIONS, read_csv

RUNS = "run string, table string, version bigint, format string, folder string, partitions array<string>"


def table_path(spark: SparkSession, table: str, root: str | None = None) -> str:
    return f"{(root or work_root(spark)).rstrip('/')}/{table}"


def runs(spark: SparkSession, root: str | None = None) -> DataFrame:
    """The table of runs: one row a version."""
    try:
        return spark.read.schema(RUNS).option("mode", "FAILFAST").json(table_path(spark, "_runs", root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RUNS)


def _version(spark: SparkSession, table: str, version: int | None, root: str | None) -> Row | None:
    """The row of a version of ``table``, of the greatest if none is named."""
    rows = runs(spark, root).where(F.col("table") == table)
    rows = rows if version is None else rows.where(F.col("version") == version)
    return rows.orderBy(F.desc("version"), F.desc("run")).first()


def current_version(spark: SparkSession, table: str, root: str | None = None) -> tuple[int, str] | None:
    """(version, format) of the current version, or None when nothing was published."""
    row = _version(spark, table, None, root)
    return row and (row["version"], row["format"])


def _read(spark: SparkSession, row: Row, schema: T.StructType | None, root: str | None, partitions: bool) -> DataFrame:
    path = f"{table_path(spark, row['table'], root)}/{row['folder']}"
    if row["format"] == "csv":
        if schema is None:
            raise ValueError("a CSV version needs a declared schema")
        return read_csv(spark, path, schema)
    df = (spark.read.schema(schema) if schema is not None and not row["partitions"] else spark.read).parquet(path)
    return df if partitions else df.drop(*(row["partitions"] or []))


def read_version(spark: SparkSession, table: str, version: int | None = None, schema: T.StructType | None = None,
                 root: str | None = None, partitions: bool = False) -> DataFrame:
    """A version of ``table``, by default the current one.

    CSV versions need ``schema`` (no inference). Parquet carries its own; passing it anyway skips reading the
    file footers for it. ``partitions``: with the columns the version is partitioned by, which a filter on
    them then prunes.
    """
    row = _version(spark, table, version, root)
    if row is None:
        raise FileNotFoundError(f"table {table!r} has no published version{'' if version is None else f' {version}'}")
    return _read(spark, row, schema, root, partitions)


def read_current(spark: SparkSession, table: str, schema: T.StructType | None = None, root: str | None = None,
                 partitions: bool = False) -> DataFrame:
    """The current version of ``table``."""
    return read_version(spark, table, None, schema, root, partitions)


class Staged:
    """Versions written in one run and made current together, when ``commit`` is called.

    ``name`` names the run; a name that the table of runs holds is a run that is done (see :meth:`done`).
    """

    def __init__(self, spark: SparkSession, root: str | None = None, name: str | None = None):
        self.spark, self.root, self.name = spark, root, name or uuid.uuid4().hex
        self.written: dict[str, dict] = {}

    def done(self) -> bool:
        """Whether a run of this name has been committed."""
        return not runs(self.spark, self.root).where(F.col("run") == self.name).isEmpty()

    def write(self, df: DataFrame, table: str, fmt: str = "parquet", partitions: int | None = None,
              by: Mapping[str, Column] | None = None) -> DataFrame:
        """Write a version and return it as it reads back.

        ``fmt`` is ``parquet`` or ``csv`` (``landing.CSV_OPTIONS``, for hand-off to other tools);
        ``partitions`` coalesces the output (small tables meant for people); ``by`` adds columns to partition
        it by. Rows of one partition value come together as far as one task can hold them, and not further.
        """
        if fmt not in ("csv", "parquet"):
            raise ValueError(f"unsupported format {fmt!r}")
        row = _version(self.spark, table, None, self.root)
        entry = {"run": self.name, "table": table, "version": (row["version"] if row else 0) + 1, "format": fmt,
                 "partitions": list(by or [])}
        entry["folder"] = f"v={entry['version']}-{uuid.uuid4().hex[:12]}"
        out = df.coalesce(partitions) if partitions else df
        if by:
            out = out.withColumns(dict(by)).hint("rebalance", *by)
        writer = out.write.mode("error").partitionBy(*by or [])
        target = f"{table_path(self.spark, table, self.root)}/{entry['folder']}"
        if fmt == "csv":
            writer.options(**CSV_OPTIONS).csv(target)
        else:
            writer.parquet(target)
        self.written[table] = entry
        return _read(self.spark, Row(**entry), df.schema, self.root, False)

    def commit(self) -> dict[str, int]:
        """Make every table's new version current, by one write; returns the versions."""
        lines = [json.dumps(entry) for entry in self.written.values()]
        if lines:
            rows = self.spark.range(1, numPartitions=1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))
            rows.write.mode("append").option("compression", "none").text(table_path(self.spark, "_runs", self.root))
        return {table: entry["version"] for table, entry in self.written.items()}


def publish(df: DataFrame, table: str, fmt: str = "parquet", root: str | None = None, partitions: int | None = None,
            by: Mapping[str, Column] | None = None) -> int:
    """Write ``df`` as a new version of ``table`` and make it current."""
    staged = Staged(df.sparkSession, root)
    staged.write(df, table, fmt, partitions, by)
    return staged.commit()[table]


def publish_copies(df: DataFrame, tables: Sequence[str], fmt: str = "parquet", root: str | None = None) -> dict[str, int]:
    """Publish one frame to several tables (e.g. one per audience), current together.

    The frame is computed once: the first table is written from it, the others are copied from that written
    version, so the work is not redone and a lost executor only costs a re-read of finished files.
    """
    staged = Staged(df.sparkSession, root)
    for table in tables:
        df = staged.write(df, table, fmt)
    return staged.commit()
