"""Baseline tidying and the per-person roll-up over up to three businesses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import drop_matching, paste_na, replace_in_names, sum0

# The baseline form's group codes and the labels they stand for
# (revenue and expense blocks of businesses 1 to 3), and the name patterns of
# layout-only columns.
GROUP_LABELS = {
    "group_gn69x50": "b1_rev",
    "group_cj4oj86": "b1_exp",
    "group_wb4eu10": "b2_rev",
    "group_ub0yl99": "b2_exp",
    "group_ff57r52": "b3_rev",
    "group_xp4ro84": "b3_exp",
}
LAYOUT_PATTERNS = ("header", "note", "info")

# What the roll-up carries beside types and totals, and the column
# that names the second and third business.
CARRY_COLUMNS = ("enumerator_name", "current_loan_count", "house_ownership", "house_type",
                 "vehicle_type", "total_children", "total_children_school")
BUSINESS_NAMES = {"b2": "second_business", "b3": "third_business"}


def tidy_baseline(df: DataFrame, drop_patterns: Sequence[str] = LAYOUT_PATTERNS,
                  rename_map: Mapping[str, str] = GROUP_LABELS) -> DataFrame:
    """Drop layout columns and replace form group codes inside column names.

    A single projection: no row is touched.
    """
    return replace_in_names(drop_matching(df, drop_patterns), rename_map)


def baseline_rollup(df: DataFrame, id_col: str = "member_id",
                    businesses: Sequence[str] = ("b1", "b2", "b3")) -> DataFrame:
    """Text of all businesses and NULL-skipping totals, one row per person.

    ``all_businesses`` joins the clean types with ``', '`` and prints a
    missing one as ``NA``; totals treat NULL as 0, so a person without any
    figure totals 0. Row-wise only: no shuffle. All columns must be there.
    """
    types = [f"type_{b}_clean" for b in businesses]

    def total(measure: str):
        return sum0(*[f"{b}_total_{measure}" for b in businesses])

    out = (df.withColumn("all_businesses", paste_na(*types))
           .withColumn("total_rev", total("rev"))
           .withColumn("total_exp", total("exp"))
           .withColumn("total_prof", total("prof")))
    per_business = []
    for b in businesses:
        per_business += [BUSINESS_NAMES[b]] if b in BUSINESS_NAMES else []
        per_business += [F.col(f"type_{b}_clean").alias(f"{b}_type"), f"{b}_total_rev", f"{b}_total_exp", f"{b}_total_prof",
                         F.col(f"time_share_{b}").alias(f"{b}_months")]
    return out.select(id_col, "all_businesses", "total_rev", "total_exp", "total_prof", *per_business, *CARRY_COLUMNS)
