"""The tables behind the status-and-demographics report.

Every panel reads the finished master through ``report_master``: a derived
status per row and the dropped rows removed. ``statuses`` narrows a panel to
some derived statuses (``None``: all rows); the defaults are the report's
(active/new for age, facility, finance and access panels, all rows for the
others). Panels are single aggregates (several statistics per pass); charts
themselves are not drawn.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions import level_or_null, rank_of, round_half_even, signed_count, text_date
from fieldbook.operators.counting import (key_counts, means, medians, ranked_counts, shares,
                                          subgroup_counts, value_counts)
from fieldbook.operators.histogram import fixed_width_histogram

# The order of the status funnel, the school order of the
# education levels, and the statuses counted as still in the programme.
FUNNEL_LEVELS = ["original", "inactive", "duplicate", "missing", "not located", "new"]
EDUCATION_LEVELS = ["1st", "3rd", "4th", "5th", "6th", "7th", "8th", "9th",
                    "10th", "11th", "12th", "PUC", "Diploma", "Degree", "Post Graduate", "Others"]
IN_PROGRAMME = ("active", "new")

STATUS = "new_final_status"

# The published master is partitioned by the date on which a form was started (as the form wrote it), so
# that a panel that asks for dates reads these partitions only.
MASTER_PARTITIONS = ("start_date",)


def master_partitions() -> dict[str, Column]:
    return {"start_date": text_date("start_ts")}


def report_status(status: str = "final_status", start: str = "start_ts", rule: str = "start"):
    """Derived status of a master row.

    ``start``: no roster status and a form start -> ``new``; no roster status
    and no start -> ``missing``; else the roster status.
    ``null_is_new``: no roster status -> ``new``.
    """
    s = F.col(status)
    if rule == "start":
        return (F.when(s.isNull() & F.col(start).isNotNull(), F.lit("new"))
                .when(s.isNull(), F.lit("missing")).otherwise(s))
    if rule == "null_is_new":
        return F.coalesce(s, F.lit("new"))
    raise ValueError(f"unknown status rule {rule!r}")


def report_master(master: DataFrame, rule: str = "start") -> DataFrame:
    return master.withColumn(STATUS, report_status(rule=rule)).filter(F.col(STATUS) != "dropped")


def in_programme(df: DataFrame, statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    """Rows whose derived status is one of ``statuses`` (``None``: all rows)."""
    return df if statuses is None else df.filter(F.col(STATUS).isin(*statuses))


def status_funnel(master: DataFrame, roster: DataFrame | None = None, rule: str = "start",
                  original: int | None = None, levels: Sequence[str] = FUNNEL_LEVELS,
                  roster_status: str = "final_status") -> DataFrame:
    """Counts by derived status: gains positive, losses negative, plus ``original``.

    ``original`` is the size of the starting list: by default the roster rows
    not marked dropped, counted in the same job; an explicit number overrides
    it. ``active`` is not a bar; statuses outside ``levels`` get a NULL name
    and rank after all levels.
    """
    counts = report_master(master, rule).groupBy(STATUS).count()
    signed = counts.select(F.col(STATUS).alias("status"), signed_count(STATUS, "count").alias("count"))
    if original is None:
        if roster is None:
            raise ValueError("pass the roster or an explicit original count")
        kept = ~F.lower(F.col(roster_status)).eqNullSafe("dropped")
        orig = roster.filter(kept).agg(F.count(F.lit(1)).alias("count"))
    else:
        orig = master.sparkSession.range(1).select(F.lit(int(original)).cast("bigint").alias("count"))
    rows = signed.unionByName(orig.select(F.lit("original").alias("status"), "count"))
    return (rows.filter(F.col("status") != "active")
            .select(level_or_null("status", levels).alias("final_status"), "count",
                    rank_of("status", levels).alias("status_rank"))
            .orderBy(F.col("status_rank").asc_nulls_last()))


def waterfall_bars(funnel: DataFrame, total_label: str = "Total") -> DataFrame:
    """Start and end of each funnel bar plus a total bar from 0.

    The running sum is a window over the funnel rows (one per status level,
    a handful), so its single partition holds only those rows.
    """
    w = (Window.orderBy(F.col("status_rank").asc_nulls_last(), F.col("final_status").asc_nulls_last())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    bars = (funnel.withColumn("bar_end", F.sum("count").over(w))
            .withColumn("bar_start", F.col("bar_end") - F.col("count")))
    total = funnel.agg(F.sum("count").alias("count"), F.max("status_rank").alias("_r")).select(
        F.lit(total_label).alias("final_status"), "count",
        (F.coalesce(F.col("_r"), F.lit(0)) + 1).cast("bigint").alias("status_rank"),
        F.col("count").alias("bar_end"), F.lit(0).cast("bigint").alias("bar_start"))
    return bars.unionByName(total)


def status_crosstab(master: DataFrame, dropped: bool = False) -> DataFrame:
    """Rows per (roster status, data status, contact status) to find contradictions.

    The analysis leaves dropped rows out; first contact looks at all
    (``dropped=True``).
    """
    rm = master if dropped else report_master(master, "null_is_new")
    return rm.groupBy(F.col("final_status").alias("roster_status"), "data_status", "contact_status").count()


def status_type(master: DataFrame, before: str = "2024-12-01") -> DataFrame:
    """Rows per (status, gender, ownership) whose form started before ``before``.

    The start date is the date written in the form's own offset; inactive
    rows are left out. Of a master partitioned by it only the partitions of
    these dates are read.
    """
    rm = report_master(master, "start")
    start = F.col("start_date") if "start_date" in master.columns else text_date("start_ts")
    started = rm.filter(start < F.to_date(F.lit(before)))
    return (started.groupBy(F.col(STATUS).alias("final_status"), "gender", "ownership").count()
            .filter(F.col("final_status") != "inactive"))


def age_histogram(master: DataFrame, width: float = 5, boundary: float = 0,
                  statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    ages = in_programme(report_master(master), statuses).filter(F.col("age").isNotNull())
    return fixed_width_histogram(ages, "age", width, group="gender", boundary=boundary)


def age_summary(master: DataFrame, statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    ages = in_programme(report_master(master), statuses).filter(F.col("age").isNotNull())
    both = means(ages, ["age"]).join(F.broadcast(medians(ages, ["age"])))  # one row each
    return both.select("mean_age", "median_age", F.bround("mean_age", 2).alias("mean_age_r2"),
                       F.bround("median_age", 2).alias("median_age_r2"))


def facility_panel(master: DataFrame, statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    rows = in_programme(report_master(master), statuses).filter(F.col("facility_type").isNotNull())
    return subgroup_counts(rows, "facility_type", "ownership")


def composition_means(master: DataFrame,
                      columns: Sequence[str] = ("total_employees", "total_family_employees"),
                      statuses: Sequence[str] | None = None) -> DataFrame:
    return means(in_programme(report_master(master), statuses), columns, digits=1)


# Bin width and axis limits of the two finance charts.
FINANCE = {"daily": (50, (0, 2500)), "monthly": (500, (0, 25000))}
MEASURES = ("income", "expenses", "profits")


def _finance_rows(master: DataFrame, period: str, statuses: Sequence[str] | None) -> DataFrame:
    return in_programme(report_master(master), statuses).filter(F.col(f"{period}_expenses").isNotNull())


def finance_means(master: DataFrame, period: str = "daily",
                  statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    """Means of income, expenses and profits of in-programme rows with expenses."""
    return means(_finance_rows(master, period, statuses), [f"{period}_{m}" for m in MEASURES],
                 prefix="", suffix="_mean")


def finance_histogram(master: DataFrame, period: str = "daily", width: float | None = None,
                      limits: tuple[float, float] | None = None,
                      statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    """Histogram per measure in long form, values outside ``limits`` removed."""
    default_width, default_limits = FINANCE[period]
    cols = [f"{period}_{m}" for m in MEASURES]
    long = _finance_rows(master, period, statuses).select(*cols).unpivot([], cols, "variable", "metric")
    return fixed_width_histogram(long, "metric", width or default_width, group="variable",
                                 limits=limits or default_limits)


def finance_medians(master: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    cols = [f"{p}_{m}" for p in FINANCE for m in MEASURES]
    return medians(in_programme(report_master(master), statuses), cols)


SHARE_SPECS = (
    ("pct_bank_account", "bank_account", ("yes",)),
    ("pct_digital_payments", "digital_payments", ("yes",)),
    ("pct_smartphone_access", "smartphone_access", ("yes", "shared")),
    ("pct_smartphone_usability", "smartphone_usability", ("yes",)),
    ("pct_shared_smartphone", "smartphone_access", ("shared",)),
)


def access_shares(master: DataFrame, statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    return shares(in_programme(report_master(master), statuses), SHARE_SPECS)


# What the report says of each share, and of each mean of the finance charts.
SHARE_LABELS = (
    ("label_bank_account", "pct_bank_account", "%s%% of all members have a bank account."),
    ("label_digital_payments", "pct_digital_payments", "%s%% of all members use digital payments."),
    ("label_smartphone_access", "pct_smartphone_access", "%s%% of all members have access to smartphones."),
    ("label_smartphone_usability", "pct_smartphone_usability", "%s%% of all members can use smartphones."),
    ("label_shared_smartphone", "pct_shared_smartphone", "%s%% of all members use shared smartphones."),
)
FINANCE_LABELS = {"income": "Mean Revenue: Rs.  %s", "expenses": "Mean Expense: Rs.  %s", "profits": "Mean Profit: Rs.  %s"}


def labelled(template: str, value, digits: int):
    """A label with a number rounded half to even, written without trailing zeros; ``NA`` for a missing one."""
    text = F.format_number(round_half_even(value, digits), digits)
    plain = F.regexp_replace(F.regexp_replace(text, ",", ""), r"\.?0+$" if digits else "$^", "")
    return F.format_string(template, F.coalesce(plain, F.lit("NA")))


def access_labels(master: DataFrame, statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    """The access shares as the sentences of the report."""
    return access_shares(master, statuses).select(*[labelled(text, F.col(c), 1).alias(name) for name, c, text in SHARE_LABELS])


def finance_labels(master: DataFrame, period: str = "daily", statuses: Sequence[str] | None = IN_PROGRAMME) -> DataFrame:
    """The means of a finance chart as its labels."""
    return finance_means(master, period, statuses).select(
        *[labelled(text, F.col(f"{period}_{m}_mean"), 2).alias(f"label_{period}_{m}") for m, text in FINANCE_LABELS.items()])


def household_medians(master: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    return medians(in_programme(report_master(master), statuses),
                   ["family_size", "total_children", "total_earning_members"], digits=1)


def education_counts(master: DataFrame, column: str = "education_level_clean",
                     statuses: Sequence[str] | None = None) -> DataFrame:
    return ranked_counts(in_programme(report_master(master), statuses), column, EDUCATION_LEVELS)


def category_counts(master: DataFrame, column: str, statuses: Sequence[str] | None = None) -> DataFrame:
    return value_counts(in_programme(report_master(master), statuses), column)


def master_key_counts(master: DataFrame, keys: Sequence[str], dropped: bool = True) -> DataFrame:
    """Rows per key of the master; the analysis leaves dropped rows out (``dropped=False``)."""
    return key_counts(master if dropped else report_master(master, "null_is_new"), keys)
