"""The three runs end to end on the sf0.001 fixtures, twice."""

from __future__ import annotations

import tempfile

import pytest

from fieldbook.operators.registry import refresh_registry
from fieldbook.plans import runs
from fieldbook.plans.catalog import master_of
from fieldbook.sources.versioned import current_version, publish, read_current

DICTIONARIES = {"business_type": "business_type_clean", "origin_city": "origin_city_clean",
                "locality": "locality_clean", "education_level": "education_level_clean"}


def test_runs_end_to_end(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-runs-")
    publish(fx_small.id_master, "member_registry", root=root)
    publish(fx_small.dictionary, "business_type_clean", root=root)
    publish(fx_small.origin_dictionary, "origin_city_clean", root=root)
    publish(fx_small.locality_dictionary, "locality_clean", root=root)
    publish(fx_small.education_dictionary, "education_level_clean", root=root)

    first = runs.run_first_contact(fx_small.roster, fx_small.contact, DICTIONARIES, root=root)
    assert first["member_registry"] == 2 and first["business_type_clean"] == 2
    assert read_current(spark, "fc_raw_backup", root=root).count() == fx_small.contact.count()
    master = read_current(spark, "fc_clean_final", root=root)
    expected = master_of(fx_small)
    assert master.count() == expected.count() == 178
    assert master.exceptAll(expected.select(*master.columns)).count() == 0
    grown = read_current(spark, "business_type_clean", root=root)
    assert grown.filter("ord = 7").count() > 0

    # a second run reads the grown dictionaries and the new registry; nothing new is added
    again = runs.run_first_contact(fx_small.roster, fx_small.contact, DICTIONARIES, root=root)
    assert again["business_type_clean"] == 3
    v3 = read_current(spark, "business_type_clean", root=root)
    assert sorted(v3.collect(), key=str) == sorted(grown.collect(), key=str)
    origin = read_current(spark, "origin_city_clean", root=root)
    assert origin.columns == ["ord", "origin_city", "origin_city_clean", "origin_region_clean"]

    base = runs.run_baseline(fx_small.baseline_raw, reviewed=fx_small.baseline, root=root)
    assert base["bl_tidy_data"] == base["bl_partner_raw"] == base["bl_raw_backup"] == 1
    final = read_current(spark, "bl_final", root=root)
    assert final.count() == fx_small.baseline.count()
    assert "all_businesses" in final.columns

    rep = runs.run_report(fx_small.roster, root=root)
    assert set(runs.REPORT_TABLES) <= set(rep)
    funnel = read_current(spark, "fc_status_summary", root=root)
    assert funnel.count() == 6


def test_a_run_that_fails_leaves_every_table_as_it_was(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-runs-")
    publish(fx_small.id_master, "member_registry", root=root)
    publish(fx_small.dictionary, "business_type_clean", root=root)
    with pytest.raises(FileNotFoundError):  # one dictionary was never published
        runs.run_first_contact(fx_small.roster, fx_small.contact,
                               {"business_type": "business_type_clean", "locality": "locality_clean"}, root=root)
    assert current_version(spark, "member_registry", root=root) == (1, "parquet")
    assert current_version(spark, "business_type_clean", root=root) == (1, "parquet")
    assert current_version(spark, "fc_raw_backup", root=root) is None


def test_the_baseline_needs_its_reviewed_table(spark, fx_small):
    root = tempfile.mkdtemp(prefix="fieldbook-runs-")
    publish(fx_small.dictionary, "business_type_clean", root=root)
    with pytest.raises(TypeError):
        runs.run_baseline(fx_small.baseline_raw, root=root)
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):  # before anything is written
        runs.run_baseline(fx_small.baseline_raw, fx_small.baseline.drop("b1_total_rev"), root=root)
    assert current_version(spark, "bl_raw_backup", root=root) is None


def test_refresh_registry_may_keep_earlier_ids(spark):
    master = spark.sql("SELECT * FROM VALUES (1.0D, 'a', 'M1', 'active'), (2.0D, 'b', 'M2', 'missing'), (4.0D, 'd', NULL, 'active') "
                       "AS t(phone_number, contact_name, member_id, contact_status)")
    registry = spark.sql("SELECT * FROM VALUES (1.0D, 'a', 'M1'), (2.0D, 'b', 'M2'), (3.0D, 'c', 'M3') "
                         "AS t(phone_number, contact_name, member_id)")
    assert [r.member_id for r in refresh_registry(master, registry).collect()] == ["M1", None]
    assert [r.member_id for r in refresh_registry(master, registry, keep_existing=True).collect()] == ["M1", "M2", "M3", None]
