"""The three survey runs end to end, every output published as a new version.

    run_first_contact   roster + submissions -> raw backup, duplicate list, master,
                        rejects, next registry, grown dictionaries, partner/ops
                        exports
    run_baseline        raw baseline + ops export -> raw backup, tidy copies,
                        reconciliation lists, compacted dictionary, per-person
                        roll-up
    run_report          published master -> status tables and report panels

Registry and dictionaries are read at their current version and written as
the next one. A run writes all its versions first and makes them current
by one write at its end, so a run that fails on the way leaves every table at
the version it had, and can be repeated. Large intermediate results are written once and
read back (the master) instead of being recomputed for every output.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from fieldbook.operators import linkage, reconcile
from fieldbook.operators.dictionary import (Lookup, compact_dictionary, dictionary_feedback,
                                            standardize, standardize_roles)
from fieldbook.operators.linkage import DEFAULT_COLUMNS, LinkColumns
from fieldbook.operators.registry import assign_ids, refresh_registry
from fieldbook.operators.rollup import baseline_rollup, tidy_baseline
from fieldbook.plans import first_contact as fc
from fieldbook.plans import report as rp
from fieldbook.plans.baseline import ROLES
from fieldbook.sources.versioned import Staged, read_current


def run_first_contact(roster: DataFrame, contact: DataFrame, dictionaries: Mapping[str, str],
                      registry_table: str = "member_registry", root: str | None = None,
                      cols: LinkColumns = DEFAULT_COLUMNS, keep_existing_ids: bool = False,
                      null_means_blank: bool = False) -> dict[str, int]:
    """First contact. ``dictionaries`` maps a data column to its dictionary table.

    Returns the version written for every output table.
    """
    spark: SparkSession = roster.sparkSession
    out = Staged(spark, root)
    out.write(contact, "fc_raw_backup")
    prepared = linkage.prepare_contact(contact, cols, null_means_blank)
    out.write(linkage.duplicate_keys(prepared, cols.contact_key).withColumnRenamed(cols.contact_key, cols.roster_key),
              "fc_duplicate_phones")
    # one join, written once, gives the master and the rejects
    joined = out.write(linkage.linked(roster, contact, cols, null_means_blank), "fc_linked")
    out.write(linkage.rejects_of(joined, cols), "fc_shared_phone_rejects")

    registry = read_current(spark, registry_table, root=root)
    current = {col: read_current(spark, table, root=root) for col, table in dictionaries.items()}
    with_ids = assign_ids(linkage.members_of(joined, cols), registry, key=cols.roster_key, name=cols.contact_name)
    master = out.write(standardize(with_ids, [Lookup(col, d) for col, d in current.items()]), "fc_clean_final",
                       by=rp.master_partitions())

    out.write(refresh_registry(master, registry, key=cols.roster_key, name=cols.contact_name,
                               keep_existing=keep_existing_ids), registry_table)
    for col, table in dictionaries.items():
        lookup = Lookup(col, current[col])
        out.write(dictionary_feedback(master, current[col], lookup.key_col, lookup.value_cols, lookup.order), table)
    out.write(fc.partner_export(master), "fc_partner_export")
    out.write(fc.ops_export(master), "fc_ops_export")
    return out.commit()


def run_baseline(raw: DataFrame, reviewed: DataFrame, ops_table: str = "fc_ops_export",
                 dictionary_table: str = "business_type_clean", root: str | None = None,
                 status_is_null: bool = True, missing_ids: str = "factored") -> dict[str, int]:
    """Baseline. ``reviewed`` is the hand-reviewed baseline, which the roll-up is made from.

    ``missing_ids``: in ``fc_bl_matching``, rows without an id are listed once with the number of rows each
    is paired with (``factored``, expanded by ``reconcile.expand_missing_ids``), or ``single``, or as the
    workflow's ``pairs``, a product.

    Between the tidy copy and the roll-up the workflow hands the table over
    to people, who also name the totals; so there is no default for it. Its
    columns are checked before anything is written.
    """
    if missing_ids not in ("factored", "single", "pairs"):
        raise ValueError(f"missing_ids is 'factored', 'single' or 'pairs', not {missing_ids!r}")
    spark: SparkSession = raw.sparkSession
    dictionary = read_current(spark, dictionary_table, root=root)
    standardized = standardize_roles(reviewed, dictionary, ROLES)
    final = baseline_rollup(standardized)
    out = Staged(spark, root)
    out.write(raw, "bl_raw_backup")
    tidy = out.write(tidy_baseline(raw), "bl_tidy_data")
    out.write(tidy, "bl_partner_raw")
    ops = read_current(spark, ops_table, root=root)
    out.write(reconcile.missing_first_contact(tidy, ops, status_is_null=status_is_null), "fc_missing_data")
    out.write(reconcile.missing_baseline(ops, tidy), "bl_missing_data")
    report = reconcile.match_report(ops, tidy, status_is_null=status_is_null, pair_missing_ids=missing_ids == "pairs",
                                    factored=missing_ids == "factored")
    out.write(report, "fc_bl_matching")
    out.write(compact_dictionary(standardized, dictionary, ROLES), dictionary_table)
    out.write(final, "bl_final")
    return out.commit()


REPORT_TABLES = {
    "fc_status_summary": lambda m, r: rp.status_funnel(m, r, rule="null_is_new"),
    "fc_status_errors": lambda m, r: rp.status_crosstab(m),
    "fc_status_type": lambda m, r: rp.status_type(m),
    "report_waterfall": lambda m, r: rp.waterfall_bars(rp.status_funnel(m, r, rule="start")),
    "report_age_histogram": lambda m, r: rp.age_histogram(m),
    "report_age_summary": lambda m, r: rp.age_summary(m),
    "report_facility": lambda m, r: rp.facility_panel(m),
    "report_business_types": lambda m, r: rp.category_counts(m, "business_type_clean"),
    "report_composition": lambda m, r: rp.composition_means(m),
    "report_daily_means": lambda m, r: rp.finance_means(m, "daily"),
    "report_daily_histogram": lambda m, r: rp.finance_histogram(m, "daily"),
    "report_monthly_means": lambda m, r: rp.finance_means(m, "monthly"),
    "report_monthly_histogram": lambda m, r: rp.finance_histogram(m, "monthly"),
    "report_finance_medians": lambda m, r: rp.finance_medians(m),
    "report_access_shares": lambda m, r: rp.access_shares(m),
    "report_access_labels": lambda m, r: rp.access_labels(m),
    "report_finance_labels": lambda m, r: rp.finance_labels(m),
    "report_household_medians": lambda m, r: rp.household_medians(m),
    "report_education": lambda m, r: rp.education_counts(m),
    "report_regions": lambda m, r: rp.category_counts(m, "origin_region_clean"),
}


def run_report(roster: DataFrame, master_table: str = "fc_clean_final",
               root: str | None = None) -> dict[str, int]:
    """Report: the status tables and every panel from the published master.

    Each panel is one small job over a column-pruned read of the master; the
    master also goes out as a CSV hand-off.
    """
    spark: SparkSession = roster.sparkSession
    master = read_current(spark, master_table, root=root, partitions=True)
    out = Staged(spark, root)
    out.write(master.drop(*rp.MASTER_PARTITIONS), "first_contact_master_csv", fmt="csv")
    for table, build in REPORT_TABLES.items():
        out.write(build(master, roster), table, partitions=1)
    return out.commit()
