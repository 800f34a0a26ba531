"""Reconciling the baseline survey with the first-contact export.

Both sides get a suffix (``_bl``, ``_fc``) so their columns never collide;
ids are compared NULL-safely (a missing id matches a missing id). The
baseline status filter keeps rows *without* a status by default; set
``status_is_null=False`` for the older polarity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import agree_flag, with_suffix
from fieldbook.operators.joins import anti_join, full_outer_join


@dataclass(frozen=True)
class ReconcileColumns:
    bl_id: str = "member_id"
    bl_name: str = "member_name"
    bl_phone: str = "phone_number"
    bl_status: str = "visit_status"
    fc_id: str = "member_id"
    fc_name: str = "contact_name"
    fc_phone: str = "phone_number"


DEFAULT = ReconcileColumns()


def _status_test(cols: ReconcileColumns, status_is_null: bool) -> Column:
    status = F.col(cols.bl_status + "_bl")
    return status.isNull() if status_is_null else status.isNotNull()


def missing_first_contact(baseline: DataFrame, ops: DataFrame, cols: ReconcileColumns = DEFAULT,
                          status_is_null: bool = True) -> DataFrame:
    """Baseline rows (status filter applied) whose id is absent from first contact."""
    bl = with_suffix(baseline, "_bl")
    fc = with_suffix(ops, "_fc")
    return (anti_join(bl.filter(_status_test(cols, status_is_null)), fc, cols.bl_id + "_bl", cols.fc_id + "_fc",
                      null_safe=True)
            .select(F.col(cols.bl_id + "_bl").alias("member_id"),
                    F.col(cols.bl_name + "_bl").alias("member_name"),
                    F.col(cols.bl_phone + "_bl").alias("phone_number")))


def missing_baseline(ops: DataFrame, baseline: DataFrame, cols: ReconcileColumns = DEFAULT) -> DataFrame:
    """First-contact rows whose id is absent from the baseline."""
    bl = with_suffix(baseline, "_bl")
    fc = with_suffix(ops, "_fc")
    return (anti_join(fc, bl, cols.fc_id + "_fc", cols.bl_id + "_bl", null_safe=True)
            .select(F.col(cols.fc_id + "_fc").alias("member_id"),
                    F.col(cols.fc_name + "_fc").alias("member_name"),
                    F.col(cols.fc_phone + "_fc").alias("phone_number")))


def match_report(ops: DataFrame, baseline: DataFrame, cols: ReconcileColumns = DEFAULT,
                 status_is_null: bool = True, pair_missing_ids: bool = True, factored: bool = False) -> DataFrame:
    """Both surveys side by side on the id, with phone and name agreement.

    Full join (a row of either side without a partner is listed too), then
    the baseline status filter. The flags are ``YES``/``NO`` and NULL when a
    side is missing the value.

    A missing id matches a missing id, as in the workflow: every row without
    one is paired with every such row of the other side, a product of the
    two. With ``pair_missing_ids=False`` rows without an id are listed
    singly instead, which stays linear however many there are. So does
    ``factored``, which loses nothing: rows without an id are listed singly
    with ``n_pairs``, the rows of the other side each is paired with (every
    other row is its own, 1), and ``expand_missing_ids`` makes the pairs.
    """
    bl = with_suffix(baseline, "_bl")
    fc = with_suffix(ops, "_fc")
    bl = bl.withColumn("_bl_row", F.lit(True))
    joined = full_outer_join(fc, bl, cols.fc_id + "_fc", cols.bl_id + "_bl", null_safe=pair_missing_ids and not factored)
    fc_phone, bl_phone = F.col(cols.fc_phone + "_fc"), F.col(cols.bl_phone + "_bl")
    fc_name, bl_name = F.col(cols.fc_name + "_fc"), F.col(cols.bl_name + "_bl")
    n_pairs = []
    if factored:
        fc_missing, bl_missing = (F.col(c).isNull() for c in (cols.fc_id + "_fc", cols.bl_id + "_bl"))
        sides = {"_fc_missing": (fc, fc_missing), "_bl_missing": (bl, bl_missing & _status_test(cols, status_is_null))}
        # a row of no side's id belongs to the side whose columns it has
        from_bl = F.coalesce("_bl_row", F.lit(False))
        for name, (side, test) in sides.items():
            joined = joined.join(F.broadcast(side.filter(test).agg(F.count(F.lit(1)).alias(name))))  # one row
        none = fc_missing & bl_missing
        n_pairs = [F.when(none & from_bl, F.col("_fc_missing")).when(none, F.col("_bl_missing")).otherwise(F.lit(1).cast("bigint")).alias("n_pairs"),
                   F.when(none, F.when(from_bl, F.lit("bl")).otherwise(F.lit("fc"))).alias("missing_on")]
    return (joined.filter(_status_test(cols, status_is_null))
            .select(*n_pairs, fc_phone.alias("fc_phone_number"), fc_name.alias("fc_name"),
                    F.coalesce(F.col(cols.fc_id + "_fc"), F.col(cols.bl_id + "_bl")).alias("member_id"),
                    bl_phone.alias("bl_phone_number"), bl_name.alias("bl_name"),
                    agree_flag(fc_phone, bl_phone).alias("number_match"),
                    agree_flag(fc_name, bl_name).alias("name_match")))


def expand_missing_ids(report: DataFrame) -> DataFrame:
    """The pairs that a factored ``match_report`` stands for: as many rows as ``n_pairs`` says, on request only."""
    shown = [c for c in report.columns if c not in ("n_pairs", "missing_on")]
    fc_side, bl_side = ("fc_phone_number", "fc_name"), ("bl_phone_number", "bl_name")
    left = report.filter("missing_on = 'fc' AND n_pairs > 0").select("member_id", *fc_side)
    right = report.filter("missing_on = 'bl' AND n_pairs > 0").select(*bl_side)
    pairs = left.join(right)  # asked for: the product itself
    flags = [agree_flag(F.col("fc_phone_number"), F.col("bl_phone_number")).alias("number_match"),
             agree_flag(F.col("fc_name"), F.col("bl_name")).alias("name_match")]
    pairs = pairs.select("member_id", *fc_side, *bl_side, *flags).select(*shown)
    return report.filter("missing_on IS NULL OR n_pairs = 0").select(*shown).unionByName(pairs)
