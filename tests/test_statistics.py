"""Medians and histograms against brute force, match report without pairs, and the order of sorted outputs."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import counting
from fieldbook.operators.histogram import fixed_width_histogram
from fieldbook.operators.reconcile import expand_missing_ids, match_report

from .conftest import SF0001


@pytest.mark.parametrize("accuracy", [100_000, 20])
def test_medians_are_exact(spark, accuracy):
    rng = random.Random(accuracy)
    columns = {
        "even": [rng.gauss(0, 10) for _ in range(1000)],
        "heavy": [rng.choice([0.0, 0.0, 0.0, 1.0, rng.random()]) for _ in range(1000)],
        "same": [4.0] * 1000,
        "halves": [1.0] * 500 + [2.0] * 500,
        "some": [rng.random() if rng.random() < 0.3 else None for _ in range(1000)],
        "one": [7.0] + [None] * 999,
        "none": [None] * 1000,
    }
    rows = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(7)
    got = counting.medians(rows, list(columns), prefix="", accuracy=accuracy).first()
    for c, values in columns.items():
        known = [v for v in values if v is not None]
        assert got[c] == (statistics.median(known) if known else None), c


def test_a_mistyped_age_does_not_fail_the_histogram(spark):
    rows = spark.createDataFrame([(float(a),) for a in (20, 21, 35)] + [(9e10,)], "age double")
    found = {r.bin: r["count"] for r in fixed_width_histogram(rows, "age", 5, boundary=0).collect()}
    occupied = sorted(n for n in found.values() if n)
    assert occupied == [1, 1, 2] or occupied == [1, 1, 1, 1]


def test_a_mistyped_age_changes_no_bin_of_the_normal_range(spark):
    """Empty bins there stay listed; one rule for every range."""
    ages = [("a", float(x)) for x in (20, 21, 35, 61)] + [("b", 44.0), ("b", 20.0)]
    plain = spark.createDataFrame(ages, "g string, age double")
    mistyped = spark.createDataFrame([*ages, ("a", 9e10)], "g string, age double")
    want = {tuple(r) for r in fixed_width_histogram(plain, "age", 5, group="g", boundary=0).collect()}
    got = {tuple(r) for r in fixed_width_histogram(mistyped, "age", 5, group="g", boundary=0).collect()}
    assert want < got and {(r[0], r[4]) for r in got - want} == {("a", 1), ("b", 0)}
    assert len(want) == 2 * 9 and (("b", 2, 30.0, 35.0, 0)) in want


@pytest.mark.parametrize("gap, listed", [(10_000, 10_002), (10_001, 2)])
def test_gaps_are_listed_up_to_a_length(spark, gap, listed):
    """Wherever the gap lies in the blocks of bins that are looked at together."""
    for start in (0, 1, 9_999, 10_000, 10_001, -25_003):
        rows = spark.createDataFrame([(start + 0.5,), (start + gap + 1.5,)], "x double")
        found = fixed_width_histogram(rows, "x", 1, boundary=0).collect()
        assert len(found) == listed and sum(r["count"] for r in found) == 2
        assert {r.bin for r in found} == (set(range(listed)) if listed > 2 else {0, gap + 1})


def test_medians_of_crowded_and_far_values(spark):
    """Values that share their leading parts, both signs, subnormal and greatest doubles, infinity."""
    rng = random.Random(3)
    columns = {
        "crowded": [1e9 + k * 2.0**-20 for k in range(501)],
        "far": [s * 2.0**e for e in range(-500, 501, 2) for s in (1, -1)][:501],
        "ends": [5e-324, -5e-324, 0.0, -0.0, 1.7e308, -1.7e308, float("inf")] * 71 + [5e-324] * 4,
        "mixed": [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-300, 300) for _ in range(501)],
    }
    rows = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns)).repartition(5)
    got = counting.medians(rows, list(columns), prefix="").first()
    for c, values in columns.items():
        assert got[c] == statistics.median(values), c


def test_a_wide_grid_is_listed_in_full(spark):
    rows = spark.createDataFrame([("a", 0.5), ("a", 4999.5), ("b", 1.5)], "g string, x double")
    found = fixed_width_histogram(rows, "x", 1, group="g", boundary=0)
    assert found.count() == 2 * 5000 and found.agg(F.sum("count")).first()[0] == 3


def test_match_report_lists_rows_without_an_id_singly(spark):
    ops = spark.sql("SELECT * FROM VALUES ('M1', 'a', 1.0D), (NULL, 'b', 2.0D), (NULL, 'c', 3.0D) AS t(member_id, contact_name, phone_number)")
    base = spark.sql("SELECT * FROM VALUES ('M1', 'a', 1.0D, NULL), (NULL, 'x', 8.0D, NULL), (NULL, 'y', 9.0D, NULL) "
                     "AS t(member_id, member_name, phone_number, visit_status)")
    assert match_report(ops, base).count() == 1 + 2 * 2
    assert match_report(ops, base, pair_missing_ids=False).count() == 1 + 2 + 2


def test_the_factored_report_stands_for_the_pairs(spark):
    ops = spark.sql("SELECT * FROM VALUES ('M1', 'a', 1.0D), (NULL, 'b', 2.0D), (NULL, NULL, 3.0D), (NULL, NULL, 3.0D), ('M2', 'd', 4.0D) "
                    "AS t(member_id, contact_name, phone_number)")
    base = spark.sql("SELECT * FROM VALUES ('M1', 'a', 1.0D, NULL), (NULL, 'b', 8.0D, NULL), (NULL, NULL, NULL, NULL), (NULL, 'z', 9.0D, 'seen'), "
                     "('M3', 'e', 5.0D, NULL) AS t(member_id, member_name, phone_number, visit_status)")
    for left, right in ((ops, base), (ops.filter("member_id IS NOT NULL"), base), (ops, base.filter("member_id IS NOT NULL")), (ops.limit(0), base)):
        factored = match_report(left, right, factored=True)
        pairs = match_report(left, right)
        shown = expand_missing_ids(factored).select(*pairs.columns)
        assert sorted(shown.collect(), key=str) == sorted(pairs.collect(), key=str)
    assert match_report(ops, base, factored=True).count() == 1 + 3 + 2 + 1 + 1


def _sorted(rows, *keys):
    values = [tuple(k(r) for k in keys) for r in rows]
    return values == sorted(values)


@pytest.mark.parametrize("name, keys", [
    ("key_counts_phone_name", [lambda r: -r["count"]]),
    ("report_key_counts_uuid", [lambda r: -r["count"]]),
    ("business_type_counts", [lambda r: -r["count"]]),
    ("region_counts", [lambda r: -r["count"]]),
    ("status_funnel", [lambda r: r.status_rank]),
    ("education_counts", [lambda r: r.level_rank]),
    ("dictionary_feedback", [lambda r: r.business_type, lambda r: r.ord]),
    ("dictionary_feedback_locality", [lambda r: r.locality, lambda r: r.ord]),
    ("compact_dictionary", [lambda r: r.business_type, lambda r: r.ord]),
    ("facility_panel", [lambda r: -r.type_mean]),
])
def test_sorted_outputs(spark, name, keys):
    from __spark_entry__ import queries

    rows = queries()[name](spark, SF0001).collect()
    assert len(rows) > 1 and _sorted(rows, *keys)


def test_registry_lists_people_twice(spark):
    from __spark_entry__ import queries

    assert queries()["registry_duplicates"](spark, SF0001).count() > 0
