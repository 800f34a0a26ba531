"""Incremental ingestion of landed form exports.

Form submissions keep arriving while a survey runs; each export lands as a
file in a shared folder. Structured Streaming picks up only the new files:

* ``submissions_stream``: the landing folder as a stream with the declared
  schema and clean column names (the streaming form of ``load_submissions``);
* ``ingest_latest``: for exports that hold the whole form each time. Every
  batch is merged into a versioned table that keeps one row for each
  submission, its latest; an export landed again changes nothing, an edited
  row takes the place of the earlier one;
* ``ingest_submissions``: for exports that hold new submissions only: append
  them to a Parquet table with an exactly-once file sink.

The checkpoint lives in the shared folder, so a restarted job resumes where
it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fieldbook.functions import clean_names
from fieldbook.operators.joins import first_per_key
from fieldbook.session import work_root
from fieldbook.sources.json_forms import JsonForm, flatten, records
from fieldbook.sources.landing import CSV_OPTIONS
from fieldbook.sources.versioned import Staged, current_version, read_current

#: When and as which file a row landed.
LANDED = ("_landed_at", "_landed_as")


def submissions_stream(spark: SparkSession, landing_dir: str, raw_schema: T.StructType | JsonForm,
                       fmt: str = "csv", max_files_per_trigger: int | None = None, landed: bool = False) -> DataFrame:
    """New files of a landing folder. ``raw_schema`` is a ``JsonForm`` for ``fmt="json"``.

    ``landed`` adds ``LANDED``, by which ``ingest_latest`` tells earlier from later exports.
    """
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    when = [F.col("_metadata.file_modification_time").alias(LANDED[0]), F.col("_metadata.file_path").alias(LANDED[1])] if landed else []
    if fmt == "csv":
        stream = (reader.schema(raw_schema).options(**CSV_OPTIONS).option("enforceSchema", False)
                  .option("mode", "FAILFAST").csv(landing_dir))
    elif fmt == "parquet":
        stream = reader.schema(raw_schema).parquet(landing_dir)
    elif fmt == "json":
        texts = reader.text(landing_dir).select(*when, "value")
        return clean_names_but(flatten(records(texts), raw_schema, keep=LANDED if landed else ()), LANDED)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return clean_names_but(stream.select("*", *when), LANDED)


def clean_names_but(df: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Clean column names, some kept as they are."""
    there = [c for c in kept if c in df.columns]
    renamed = clean_names(df.drop(*there)).columns
    others = iter(renamed)
    return df.toDF(*[c if c in there else next(others) for c in df.columns])


def latest_submissions(df: DataFrame, key: str, newest: Sequence[Column]) -> DataFrame:
    """One row a submission: the first in the order ``newest``.

    Rows without a key are submissions of their own, one for each distinct
    content; they are told apart by it, so that they do not meet in one task.
    The limit per key works before the shuffle too.
    """
    content = F.sha2(F.to_json(F.struct(*[c for c in df.columns if not c.startswith("_")])), 256)
    marked = df.withColumn("_own", F.coalesce(F.concat(F.lit("key "), F.col(key).cast("string")), content))
    return first_per_key(marked, ["_own"], [*newest, content]).drop("_own")


def whole_exports(rows: DataFrame) -> DataFrame:
    """``LANDED`` of the files as that of their exports.

    The files that one write leaves (``part-<n>-<write>...``) are one export, which landed when the last of
    them in this batch did; any other file is an export of its own. There is one row an export in the table
    of times, so it is broadcast: the rows stay where they are.
    """
    when, name = LANDED
    rows = rows.withColumn(name, F.regexp_replace(name, r"/part-\d+(-[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$", "/part$1"))
    times = rows.groupBy(F.col(name).alias("_export")).agg(F.max(when).alias("_last"))
    rows = rows.join(F.broadcast(times), F.col(name).eqNullSafe(F.col("_export")), "left")
    return rows.withColumn(when, F.col("_last")).drop("_export", "_last")


def merge_batch(batch: DataFrame, batch_id: int, table: str, key: str, name: str, order: Sequence[str] = (),
                root: str | None = None) -> None:
    """Merge one batch into the current version of ``table`` and make the result current.

    A later export beats an earlier one, and within an export, whichever of
    its files they are in, the greater values of ``order`` win. The run is named after the batch: a batch that
    comes again after a restart finds its run committed and does nothing.
    """
    spark = batch.sparkSession
    staged = Staged(spark, root, name=f"{name} batch {batch_id}")
    if staged.done():
        return
    rows = whole_exports(batch) if set(LANDED) <= set(batch.columns) else batch
    rows = rows.withColumn("_turn", F.lit(1))
    if current_version(spark, table, root) is not None:
        old = read_current(spark, table, root=root).withColumn("_turn", F.lit(0))
        rows = rows.unionByName(old, allowMissingColumns=True)
    there = [c for c in ("_turn", *LANDED, *order) if c in rows.columns]
    newest = [F.col(c).desc_nulls_last() for c in there]
    staged.write(latest_submissions(rows, key, newest).drop("_turn", *LANDED), table)
    staged.commit()


def ingest_latest(stream: DataFrame, table: str, key: str = "uuid", name: str = "submissions", order: Sequence[str] = (),
                  root: str | None = None, checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Keep ``table`` (versioned) at the latest row of every submission, batch by batch.

    Each batch writes the table anew, in the order of the export itself, which
    holds the whole form. ``name`` names the ingestion for its checkpoint and
    its runs; it must stay the same across restarts.
    """
    spark = stream.sparkSession
    writer = (stream.writeStream
              .foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, table, key, name, order, root))
              .option("checkpointLocation", _checkpoint(spark, name, checkpoint)))
    return _triggered(writer, available_now).queryName(name).start()


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{work_root(spark)}/_streams/{name}"


def _triggered(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")


def ingest_submissions(stream: DataFrame, table_dir: str, name: str = "submissions",
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Append the stream to ``table_dir`` (Parquet), exactly once per file."""
    spark = stream.sparkSession
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", table_dir)
              .option("checkpointLocation", _checkpoint(spark, name, checkpoint)))
    return _triggered(writer, available_now).queryName(name).start()
