"""Versioned publish: read-modify-write of the same table, CSV hand-off."""

from __future__ import annotations

import json
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldbook.operators.dictionary import dictionary_feedback, standardize, Lookup
from fieldbook.sources import schemas
from fieldbook.sources.landing import BAD_ROW, FILE_ROWS, load_submissions, read_csv, write_export
from fieldbook.sources.versioned import Staged, current_version, publish, publish_copies, read_current, read_version, runs


def test_read_modify_write_same_table(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    assert publish(fx_small.dictionary, "business_type_clean", root=root) == 1
    current = read_current(spark, "business_type_clean", root=root)
    data = standardize(fx_small.contact, [Lookup("business_type", current)])
    grown = dictionary_feedback(data, current, "business_type", "business_type_clean")
    assert publish(grown, "business_type_clean", root=root) == 2
    assert current_version(spark, "business_type_clean", root=root) == (2, "parquet")
    assert read_current(spark, "business_type_clean", root=root).count() == grown.count()
    # version 1 is untouched
    assert read_version(spark, "business_type_clean", 1, root=root).count() == 7


def test_csv_round_trip_keeps_blanks_and_nulls(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    raw = schemas.raw_schema(schemas.CONTACT)
    contact = fx_small.contact.select(*schemas.CONTACT.fieldNames())
    write_export(contact, f"{root}/export", raw.fieldNames())
    back = load_submissions(spark, f"{root}/export", raw)
    assert back.columns == contact.columns
    assert back.exceptAll(contact).count() == 0 and contact.exceptAll(back).count() == 0
    assert back.filter("data_status = ''").count() == contact.filter("data_status = ''").count() > 0


def test_an_export_is_files_of_bounded_size(spark):
    """Cells may hold line breaks, so a task reads whole files: one task's rows are written to several."""
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    rows = spark.range(0, FILE_ROWS + 1, 1, 1).selectExpr("concat('line ', id, chr(10), 'next') AS `a name`", "id AS n")
    write_export(rows, f"{root}/export")
    write_export(rows.limit(25), f"{root}/small", file_rows=10)
    for folder, most, files in (("export", FILE_ROWS, 2), ("small", 10, 3)):
        back = load_submissions(spark, f"{root}/{folder}", rows.schema)
        counts = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
        assert len(counts) == files and max(counts) == most
    assert load_submissions(spark, f"{root}/export", rows.schema).exceptAll(rows).isEmpty()


def test_one_frame_to_two_tables(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    versions = publish_copies(fx_small.baseline, ["bl_tidy", "bl_partner"], root=root)
    assert versions == {"bl_tidy": 1, "bl_partner": 1}
    a = read_current(spark, "bl_tidy", root=root)
    b = read_current(spark, "bl_partner", root=root)
    assert a.count() == b.count() == fx_small.baseline.count()
    assert a.exceptAll(b).count() == 0


def _two_versions(spark):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    assert publish(spark.range(10), "t", root=root) == 1
    assert publish(spark.range(5), "t", root=root) == 2
    return root


def test_a_run_is_rows_of_one_table(spark):
    root = _two_versions(spark)
    staged = Staged(spark, root)
    staged.write(spark.range(4), "t")
    staged.write(spark.range(1), "other")
    staged.commit()
    rows = sorted((r.table, r.version) for r in runs(spark, root).collect())
    assert rows == [("other", 1), ("t", 1), ("t", 2), ("t", 3)]
    assert len(list(Path(root, "_runs").glob("part-*"))) == 3  # one file a run, whole or not there


def test_an_unreadable_row_is_an_error(spark):
    root = _two_versions(spark)
    Path(root, "_runs", "part-broken.json").write_text('{"run": "x", "table"')
    with pytest.raises(Exception, match="(?i)malformed"):
        publish(spark.range(3), "t", root=root)
    with pytest.raises(Exception, match="(?i)malformed"):
        current_version(spark, "t", root=root)


def test_what_an_earlier_run_left_is_neither_read_nor_overwritten(spark):
    root = _two_versions(spark)
    dead = Staged(spark, root)
    assert dead.write(spark.range(7), "t").count() == 7  # and then it dies
    assert read_current(spark, "t", root=root).count() == 5
    assert publish(spark.range(3), "t", root=root) == 3
    assert [read_version(spark, "t", v, root=root).count() for v in (1, 2, 3)] == [10, 5, 3]
    assert len([p for p in Path(root, "t").iterdir() if p.name.startswith("v=3-")]) == 2


def test_staged_versions_become_current_together(spark):
    root = _two_versions(spark)
    staged = Staged(spark, root)
    assert staged.write(spark.range(4), "t").count() == 4
    staged.write(spark.range(1), "other")
    assert current_version(spark, "t", root=root) == (2, "parquet") and current_version(spark, "other", root=root) is None
    assert staged.commit() == {"t": 3, "other": 1}
    assert read_current(spark, "t", root=root).count() == 4


def test_a_commit_that_dies_half_way_leaves_every_table_old(spark):
    """The task that writes the rows of a run fails after the first of them: no table has a new version."""
    root = _two_versions(spark)
    publish(spark.range(2), "other", root=root)
    staged = Staged(spark, root)
    staged.write(spark.range(4), "t")
    staged.write(spark.range(1), "other")
    lines = [json.dumps(e) for e in staged.written.values()]
    dying = spark.range(1, numPartitions=1).select(F.explode(F.array(*map(F.lit, lines))).alias("value"))
    dying = dying.select(F.when(F.col("value").contains('"other"'), F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col("value")).alias("value"))
    with pytest.raises(Exception, match="killed"):
        dying.write.mode("append").text(f"{root}/_runs")
    assert current_version(spark, "t", root=root) == (2, "parquet") and current_version(spark, "other", root=root) == (1, "parquet")
    assert staged.commit() == {"t": 3, "other": 2}  # done again


def test_a_run_has_a_name(spark):
    root = _two_versions(spark)
    staged = Staged(spark, root, name="batch 7")
    assert not staged.done()
    staged.write(spark.range(4), "t")
    assert not staged.done()
    staged.commit()
    assert staged.done() and Staged(spark, root, name="batch 7").done()


def test_partitions_are_read_on_request(spark):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    df = spark.sql("SELECT id, if(id % 3 = 0, NULL, date_add(DATE '2024-11-30', CAST(id % 3 AS INT))) AS d FROM range(90)")
    publish(df, "t", root=root, by={"day": F.col("d")})
    assert read_current(spark, "t", root=root).columns == ["id", "d"] and read_current(spark, "t", root=root).count() == 90
    whole = read_current(spark, "t", root=root, partitions=True)
    assert whole.filter("day IS NULL").count() == 30 and whole.filter("day < DATE '2024-12-02'").count() == 30
    assert whole.filter("NOT day <=> d").count() == 0


def test_a_table_or_version_that_is_not_there(spark):
    root = _two_versions(spark)
    for call in (lambda: read_current(spark, "none", root=root), lambda: read_version(spark, "t", 9, root=root)):
        with pytest.raises(FileNotFoundError):
            call()
    assert publish_copies(spark.range(2), [], root=root) == {}


SCHEMA = T.StructType([T.StructField("Business Type", T.StringType()), T.StructField("Age", T.DoubleType())])


def _file(text):
    path = Path(tempfile.mkdtemp(prefix="fieldbook-test-"), "export.csv")
    path.write_text(text)
    return str(path)


def test_text_with_line_breaks_quotes_and_commas(spark):
    root = tempfile.mkdtemp(prefix="fieldbook-test-")
    rows = [("one\ntwo", 1.0), ('say "a", b', 2.0), ("\n\n", None), (None, 3.0), ("", 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    publish(df, "t", fmt="csv", root=root)
    assert sorted(map(tuple, read_current(spark, "t", schema=SCHEMA, root=root).collect()), key=str) == sorted(rows, key=str)


def test_a_header_that_does_not_fit_is_refused(spark):
    path = _file("Age,Business Type\n3,shop\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_submissions(spark, path, SCHEMA).collect()


def test_bad_rows_fail_or_are_reported(spark):
    path = _file("Business Type,Age\nshop,3\ncart,three\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_submissions(spark, path, SCHEMA).collect()
    rows = {r["Business Type"]: r for r in read_csv(spark, path, SCHEMA, bad_rows="report").collect()}
    assert rows["shop"][BAD_ROW] is None and rows["cart"][BAD_ROW] == "cart,three" and rows["cart"]["Age"] is None


def test_blanks_may_be_missing_values(spark):
    path = _file('Business Type,Age\n"",3\nNA,4\nshop,5\n')
    as_typed = [r[0] for r in read_csv(spark, path, SCHEMA).orderBy("Age").collect()]
    as_missing = [r[0] for r in load_submissions(spark, path, SCHEMA, blank_as_null=True).orderBy("age").collect()]
    assert as_typed == ["", None, "shop"] and as_missing == [None, None, "shop"]


def test_a_file_without_line_breaks_is_split(spark):
    path = _file("Business Type,Age\n" + "".join(f"shop number {k},{k % 90}\n" for k in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        whole, split = (load_submissions(spark, path, SCHEMA, line_breaks=b) for b in (True, False))
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert split.count() == 20_000 and split.exceptAll(whole).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
