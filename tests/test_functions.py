"""Row semantics of the column helpers, on tiny frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fieldbook.functions import (agree_flag, blank_to, clean_text, level_or_null, padded_id, paste_na, rank_of,
                                 recode, round_half_even, signed_count, squeeze_first, sum0, text_date,
                                 to_number, trim_all)


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("v")).collect()]


def test_trim_all_strips_unicode_white_space(spark):
    rows = [(" a ",), ("\ta ",), (" x y\n",), (None,), ("",)]
    assert one(spark, trim_all("s"), rows, "s string") == ["a", "a", "x y", None, ""]


def test_squeeze_first_replaces_only_the_first_double_space(spark):
    rows = [("a  b  c",), ("a b",), ("  lead",), (None,)]
    assert one(spark, squeeze_first("s"), rows, "s string") == ["a b  c", "a b", " lead", None]


def test_clean_text_trims_before_squeezing(spark):
    rows = [("  BUILDING  store  ",), (" x  a  b",)]
    assert one(spark, clean_text("s"), rows, "s string") == ["BUILDING store", "x a  b"]


def test_agree_flag_is_three_valued(spark):
    rows = [(1.0, 1.0), (1.0, 2.0), (None, 1.0), (None, None)]
    assert one(spark, agree_flag("a", "b"), rows, "a double, b double") == ["YES", "NO", None, None]


def test_blank_to_keeps_null_unless_asked(spark):
    rows = [("",), (None,), ("new",)]
    assert one(spark, blank_to("s", "existing"), rows, "s string") == ["existing", None, "new"]
    assert one(spark, blank_to("s", "existing", null_is_blank=True), rows, "s string") == [
        "existing", "existing", "new"]


def test_recode_keeps_other_values(spark):
    rows = [("yes",), ("no",), ("unsure",), (None,)]
    out = one(spark, recode("s", {"yes": "active", "no": "missing"}), rows, "s string")
    assert out == ["active", "missing", "unsure", None]


def test_to_number_rejects_text_and_suffixes(spark):
    rows = [("9000000001",), ("n/a",), ("12d",), (" 1e3 ",), ("-2.5",), (None,), ("",)]
    assert one(spark, to_number("s"), rows, "s string") == [9000000001.0, None, None, 1000.0, -2.5, None, None]


def test_sum0_treats_null_as_zero(spark):
    rows = [(1.0, None, 2.0), (None, None, None)]
    assert one(spark, sum0("a", "b", "c"), rows, "a double, b double, c double") == [3.0, 0.0]


def test_paste_na_prints_missing_as_na(spark):
    rows = [("Groceries", None, None), ("A", "B", "C")]
    assert one(spark, paste_na("a", "b", "c"), rows, "a string, b string, c string") == [
        "Groceries, NA, NA", "A, B, C"]


def test_text_date_uses_the_written_date(spark):
    rows = [("2024-12-01T03:00:00.000+05:30",), ("2024-11-30T23:59:00.000-08:00",), ("n/a",), (None,)]
    out = one(spark, text_date("s"), rows, "s string")
    assert out == [dt.date(2024, 12, 1), dt.date(2024, 11, 30), None, None]


def test_rank_of_unlisted_ranks_last(spark):
    rows = [("PUC",), ("CA",), (None,)]
    assert one(spark, rank_of("s", ["10th", "PUC"]), rows, "s string") == [2, 3, 3]
    assert one(spark, level_or_null("s", ["10th", "PUC"]), rows, "s string") == ["PUC", None, None]


def test_round_half_even(spark):
    rows = [(0.25,), (0.35,), (2.5,), (3.5,)]
    assert one(spark, round_half_even("x", 1), rows, "x double")[:2] == [0.2, 0.4]
    assert one(spark, round_half_even("x", 0), rows, "x double")[2:] == [2.0, 4.0]


def test_signed_count(spark):
    rows = [("new", 3), ("missing", 4), ("active", 2)]
    assert one(spark, signed_count("s", "n"), rows, "s string, n long") == [3, -4, 2]


def test_when_otherwise_no_fallback_gives_naive_count(spark):
    """The naive flag calls every missing comparison a disagreement."""
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 1.0)], "a double, b double")
    naive = df.select(F.when(F.col("a") == F.col("b"), "YES").otherwise("NO").alias("f"))
    assert [r.f for r in naive.collect()] == ["NO", "NO", "YES"]
    assert [r.f for r in df.select(agree_flag("a", "b").alias("f")).collect()] == [None, None, "YES"]


def test_padded_id_does_not_truncate(spark):
    rows = [(7,), (42,), (1234,), (None,)]
    assert one(spark, padded_id("M", "i"), rows, "i long") == ["M007", "M042", "M1234", None]
