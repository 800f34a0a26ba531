"""Incremental ingestion: two landed batches, exactly-once append."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from fieldbook.sources import schemas
from fieldbook.sources.json_forms import to_records
from fieldbook.sources.landing import write_export
from fieldbook.sources.versioned import current_version, read_current
from fieldbook.streaming.ingest import ingest_latest, ingest_submissions, latest_submissions, merge_batch, submissions_stream


def test_landed_batches_are_ingested_once(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-stream-")
    raw = schemas.raw_schema(schemas.CONTACT)
    contact = fx_small.contact.select(*schemas.CONTACT.fieldNames())
    first = contact.filter("CAST(submission_no AS BIGINT) % 2 = 0")
    second = contact.filter("CAST(submission_no AS BIGINT) % 2 = 1")
    write_export(first, f"{root}/landing/b1", raw.fieldNames())

    def run():
        stream = submissions_stream(spark, f"{root}/landing/*", raw)
        q = ingest_submissions(stream, f"{root}/table", name="contact_ingest", checkpoint=f"{root}/ckpt")
        q.awaitTermination()

    run()
    assert spark.read.parquet(f"{root}/table").count() == first.count()
    write_export(second, f"{root}/landing/b2", raw.fieldNames())
    run()
    run()  # nothing new: no duplicates
    table = spark.read.parquet(f"{root}/table")
    assert table.count() == contact.count()
    assert table.exceptAll(contact).count() == 0


def test_whole_exports_landed_again_leave_one_row_a_submission(spark, fx_small):
    """The same export twice, then one with an edited row and a new one, with a restart after each."""
    root = tempfile.mkdtemp(prefix="fieldbook-stream-")
    raw = schemas.raw_schema(schemas.CONTACT)
    contact = fx_small.contact.select(*schemas.CONTACT.fieldNames()).filter("CAST(submission_no AS BIGINT) % 50 <> 1")  # one row a uuid
    first = contact.filter("uuid <> 'u2'")
    edited = contact.withColumn("notes", F.when(F.col("uuid") == "u3", F.lit("seen again")).otherwise(F.col("notes")))

    def run(folder, rows):
        write_export(rows, f"{root}/landing/{folder}", raw.fieldNames())
        stream = submissions_stream(spark, f"{root}/landing/*", raw, landed=True)
        ingest_latest(stream, "submissions", root=root, checkpoint=f"{root}/ckpt").awaitTermination()
        return read_current(spark, "submissions", root=root)

    assert run("e1", first).exceptAll(first).count() == 0
    again = run("e2", first)
    assert again.count() == first.count() and again.exceptAll(first).count() == 0
    last = run("e3", edited)
    assert last.count() == contact.count() and last.exceptAll(edited).count() == 0
    assert [r.notes for r in last.filter("uuid = 'u3'").collect()] == ["seen again"]
    back = run("e4", contact)  # the edit is taken back
    assert back.exceptAll(contact).count() == 0 and contact.exceptAll(back).count() == 0


def test_a_batch_that_comes_again_does_nothing(spark):
    """As after a crash between the commit of a batch and its checkpoint."""
    root = tempfile.mkdtemp(prefix="fieldbook-stream-")
    old = spark.sql("SELECT 'a' AS uuid, 1 AS x")
    new = spark.sql("SELECT 'a' AS uuid, 2 AS x")
    for batch, number in ((old, 0), (new, 1), (old, 0), (new, 1)):
        merge_batch(batch, number, "t", "uuid", "job", root=root)
    assert [tuple(r) for r in read_current(spark, "t", root=root).collect()] == [("a", 2)]
    assert current_version(spark, "t", root=root) == (2, "parquet")


def test_files_of_one_export_land_together(spark):
    """Rows of one export are told apart by ``order``, whichever of its files was done first."""
    root = tempfile.mkdtemp(prefix="fieldbook-stream-")
    one, two = (f"-0000000{k}-aaaa-bbbb-cccc-0123456789ab-c000.csv" for k in (1, 2))
    rows = [("a", 2, 10, f"/e/part-00000{one}"), ("a", 1, 20, f"/e/part-00001{one}"),
            ("b", 2, 10, f"/e/part-00000{one}"), ("b", 1, 30, f"/e/part-00000{two}"),  # a later export beats it
            ("c", 2, 10, "/e/typed.csv"), ("c", 1, 20, "/e/other.csv")]  # files of their own
    batch = spark.createDataFrame(rows, "uuid string, x int, _landed_at int, _landed_as string")
    merge_batch(batch, 0, "t", "uuid", "job", order=("x",), root=root)
    assert sorted(map(tuple, read_current(spark, "t", root=root).collect())) == [("a", 2), ("b", 1), ("c", 1)]


def test_the_latest_row_of_each_submission(spark):
    rows = spark.sql("SELECT * FROM VALUES ('a', 1, 5), ('a', 2, 4), ('b', 1, 1), (NULL, 1, 1), (NULL, 1, 1), (NULL, 2, 1) AS t(uuid, x, _turn)")
    got = latest_submissions(rows, "uuid", [F.col("_turn").desc()]).drop("_turn")
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 1), ("b", 1), (None, 1), (None, 2)]


def test_json_files_stream_too(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-stream-")
    form = schemas.contact_form(nested=True)
    to_records(fx_small.contact, form).write.text(f"{root}/landing/e1")
    stream = submissions_stream(spark, f"{root}/landing/*", form, fmt="json", landed=True)
    ingest_latest(stream, "submissions", root=root, checkpoint=f"{root}/ckpt", order=("form_index",)).awaitTermination()
    got = read_current(spark, "submissions", root=root)
    assert got.count() == fx_small.contact.select("uuid").distinct().count()
    assert got.exceptAll(fx_small.contact.select(*got.columns)).count() == 0
