"""Planted counts of the fixture views at sf0.01 (FIXTURES.md section 2.1)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from fieldbook.operators import linkage, reconcile
from fieldbook.operators.dictionary import Lookup, dictionary_feedback, first_match, standardize
from fieldbook.operators.histogram import fixed_width_histogram
from fieldbook.operators.registry import assign_ids
from fieldbook.plans import report as rp
from fieldbook.plans.catalog import master_of


@pytest.fixture(scope="module")
def master0(fx):
    return linkage.build_master(fx.roster, fx.contact).cache()


@pytest.fixture(scope="module")
def master4(fx):
    return linkage.link_members(fx.roster, fx.contact).cache()


def test_fixture_sizes(fx):
    assert (fx.roster.count(), fx.contact.count(), fx.id_master.count(), fx.baseline.count()) == (
        1500, 1200, 1143, 1000)  # 17 people are listed twice in the registry


def test_master_join(master0):
    assert master0.count() == 1972
    assert master0.filter("roster_no IS NULL").count() == 314
    assert master0.filter("uuid IS NULL").count() == 573
    assert master0.filter("phone_number IS NULL").count() == 289


def test_duplicate_phones(fx):
    assert linkage.duplicate_keys(linkage.prepare_contact(fx.contact), "contact_phone").count() == 79


def test_shared_phones(fx, master0):
    shared = (master0.filter("data_status = 'existing' AND phone_number IS NOT NULL")
              .groupBy("phone_number").count().filter("count > 1"))
    assert shared.count() == 118
    r = linkage.prepare_roster(fx.roster)
    c = linkage.prepare_contact(fx.contact)
    assert linkage.shared_keys(r, c).count() == 118


def test_shared_rule_kept_lost_untouched(master0, master4):
    shared = (master0.filter("data_status = 'existing' AND phone_number IS NOT NULL")
              .groupBy("phone_number").count().filter("count > 1").select("phone_number"))
    on_shared = master0.join(shared, "phone_number", "left_semi")
    kept = on_shared.filter(F.col("contact_name") == F.col("roster_name")).count()
    untouched = master0.join(shared, "phone_number", "left_anti").count()
    assert (kept, on_shared.count() - kept, untouched) == (170, 224, 1578)
    assert master4.count() == 1748


def test_id_join_null_safe_against_plain(fx, master4):
    with_ids = assign_ids(master4, fx.id_master)
    assert with_ids.count() == 1748 + 13  # people listed twice give two rows
    assert with_ids.filter("member_id IS NOT NULL").count() == 695 + 13
    reg = fx.id_master.select(F.col("phone_number").alias("p"), F.col("contact_name").alias("n"), "member_id")
    plain = (master4.withColumn("contact_name", F.trim("contact_name"))
             .join(reg, (F.col("phone_number") == F.col("p")) & (F.col("contact_name") == F.col("n")), "left"))
    assert plain.filter("member_id IS NOT NULL").count() == 629 + 12


def test_dictionary_first_match(fx):
    std = standardize(fx.contact, [Lookup("business_type", fx.dictionary)])
    assert std.count() == 1200
    assert std.filter("business_type_clean IS NOT NULL").count() == 408
    hit = fx.dictionary.select(F.col("business_type").alias("k")).distinct()
    hit_null = std.filter("business_type_clean IS NULL").join(
        hit, F.col("business_type").eqNullSafe(F.col("k")), "left_semi").count()
    assert hit_null == 85
    assert 1200 - 408 - hit_null == 707
    # forgetting the first-match rule fans rows out
    fanned = std.drop("business_type_clean").join(
        fx.dictionary, "business_type", "left")
    assert fanned.count() == 1365
    assert first_match(fx.dictionary, "business_type", ["business_type_clean"]).count() == 5


def test_replace_first_differs_from_replace_all(fx):
    t = F.trim("business_type")
    first = F.regexp_replace(t, r"(?s)^(.*?)  ", "$1 ")
    every = F.regexp_replace(t, "  ", " ")
    assert fx.contact.filter(first != every).count() == 200


def test_feedback_new_keys(fx):
    master = master_of(fx)
    fb = dictionary_feedback(master, fx.dictionary, "business_type", "business_type_clean")
    unmatched = (master.filter("business_type_clean IS NULL AND business_type <> ''")
                 .select("business_type").distinct())
    assert unmatched.count() == 12
    assert fb.filter("ord = 7").count() == 11  # placed after the 7 listed rows; MACHINERY is listed


def test_funnel_rules(fx):
    master = master_of(fx)
    assert master.filter("final_status IS NULL").count() == 499  # all become new
    st = rp.report_master(master, "start")
    counts = {r[0]: r[1] for r in st.groupBy(rp.STATUS).count().collect()}
    assert (counts["new"], counts["missing"]) == (428, 245)


def test_start_date_text_against_instant(fx):
    text = fx.contact.filter(rp.text_date("start_ts") < F.to_date(F.lit("2024-12-01"))).count()
    instant = fx.contact.filter(F.to_date(F.to_timestamp("start_ts")) < F.to_date(F.lit("2024-12-01"))).count()
    assert (text, instant) == (600, 750)


def test_repeated_uuid(fx):
    assert fx.contact.groupBy("uuid").count().filter("count > 1").count() == 30


def test_reconcile_null_safe_against_plain(fx):
    assert reconcile.missing_first_contact(fx.baseline, fx.id_master).count() == 244
    assert reconcile.missing_baseline(fx.id_master, fx.baseline).count() == 389 + 17
    plain_bl = (fx.baseline.filter("visit_status IS NULL")
                .join(fx.id_master.select(F.col("member_id").alias("m")), F.col("member_id") == F.col("m"),
                      "left_anti"))
    assert plain_bl.count() == 262
    report = reconcile.match_report(fx.id_master, fx.baseline)
    assert report.count() == 1289 + 17
    assert report.filter("number_match = 'NO'").count() == 37
    naive = report.select(F.when(F.col("fc_phone_number") == F.col("bl_phone_number"), "YES")
                          .otherwise("NO").alias("f"))
    assert naive.filter("f = 'NO'").count() == 745 + 17


def test_all_null_revenue_totals_zero(fx):
    from fieldbook.plans.baseline import baseline_final

    final = baseline_final(fx.baseline, fx.dictionary)
    zero = final.filter("b1_total_rev IS NULL AND b2_total_rev IS NULL AND b3_total_rev IS NULL")
    assert zero.count() == 50
    assert zero.filter("total_rev = 0.0").count() == 50


def test_age_bin_edges(fx):
    assert fx.contact.filter("age = 20").count() == 29
    hist = fixed_width_histogram(fx.contact, "age", 5, boundary=0)
    binned = fx.contact.filter("age IS NOT NULL").select(
        (F.greatest(F.ceil((F.col("age") - 20) / 5) - 1, F.lit(0))).alias("right"),
        F.floor((F.col("age") - 20) / 5).alias("left"))
    assert binned.filter("right <> left").count() == 232
    assert hist.agg(F.sum("count")).first()[0] == fx.contact.filter("age IS NOT NULL").count()


def test_finance_censoring(fx):
    cols = ["daily_income", "daily_expenses", "daily_profits"]
    long = fx.contact.filter("daily_expenses IS NOT NULL").select(*cols).unpivot([], cols, "variable", "metric")
    assert (long.filter("metric < 0").count(), long.filter("metric > 2500").count(),
            long.filter("metric IS NOT NULL").count()) == (188, 39, 2100)


def test_facility_sort_key(fx):
    from fieldbook.operators.counting import subgroup_counts

    panel = subgroup_counts(fx.contact.filter("facility_type IS NOT NULL"), "facility_type", "ownership")
    means = {r.facility_type: round(r.type_mean, 2) for r in panel.select("facility_type", "type_mean")
             .distinct().collect()}
    assert means == {"shop": 166.67, "home": 83.33, "mobile_cart": 75.0}
