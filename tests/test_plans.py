"""Plan properties the README claims, checked on the physical plans."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import queries

from .conftest import SF0001
from .test_skew import session_conf


def _plan(df, final: bool = False) -> str:
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dictionary_lookup_is_broadcast_with_partial_group_limit(spark):
    plan = _plan(queries()["standardize"](spark, SF0001))
    assert plan.count("BroadcastHashJoin") >= 3
    assert plan.count("WindowGroupLimit") >= 6  # a partial and a final limit per dictionary


def test_report_panel_reads_only_its_columns(spark):
    plan = _plan(queries()["access_shares"](spark, SF0001))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    in_files = [[c for c in cols.split(",") if not c.startswith("start_date#")] for cols in scans]  # that one is a folder's name
    assert in_files and all(len(cols) <= 6 for cols in in_files)  # of about 40 columns


def test_no_job_runs_while_a_plan_is_built(spark):
    """Sizes decide at run time, by AQE; nothing is counted beforehand."""
    sc = spark.sparkContext
    sc.setJobGroup("planning", "planning")
    try:
        for name in ("build_master", "resolve_shared_keys", "assign_ids", "standardize", "first_contact_master", "match_report"):
            queries()[name](spark, SF0001)
        assert not sc.statusTracker().getJobIdsForGroup("planning")
    finally:
        sc._jsc.clearJobGroup()


def test_the_medians_of_a_panel_gather_no_distinct_values(spark):
    plan = _plan(queries()["finance_medians"](spark, SF0001))
    assert "collect_list" not in plan and "percentile" not in plan and " median(" not in plan


BY_SHUFFLE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.mark.parametrize("name, scans, joins", [("build_master", 4, 3), ("resolve_shared_keys", 4, 5)])
def test_linking_reads_its_inputs_twice(spark, name, scans, joins):
    """Without broadcasts: each input once for the keys and once for the rows, however often these are used."""
    with session_conf(spark, BY_SHUFFLE):
        plan = _plan(queries()[name](spark, SF0001), final=True).split("== Initial Plan ==")[0]
    rows = [line for line in plan.splitlines() if "FileScan parquet" in line and "c_custkey" in line]
    of_the_views = plan.count("n_nationkey") and sum("SortMergeJoin" in line and "nationkey" in line for line in plan.splitlines())
    assert len(rows) <= scans
    assert sum("SortMergeJoin" in line for line in plan.splitlines()) - of_the_views <= joins


def test_status_type_reads_the_partitions_it_asks_for(spark):
    plan = _plan(queries()["status_type"](spark, SF0001))
    assert re.search(r"PartitionFilters: \[[^\]]*start_date#\d+ < 2024-12-01", plan)
