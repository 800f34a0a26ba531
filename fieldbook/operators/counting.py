"""Counts, shares, means and medians as single-pass aggregates.

All of these are hash aggregates with a partial (map-side) step, so a hot
group costs one row per map task in the shuffle. Several statistics of one
panel are computed in one ``agg`` (one scan).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldbook.functions import rank_of, round_half_even


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key combination (NULL is a key), most frequent first."""
    keys = list(keys)
    return df.groupBy(*keys).count().orderBy(F.desc("count"), *[F.asc_nulls_last(k) for k in keys])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return key_counts(df.filter(F.col(column).isNotNull()), [column])


def ranked_counts(df: DataFrame, column: str, levels: Sequence[str], rank_col: str = "level_rank") -> DataFrame:
    """Rows per non-NULL value with the value's position in ``levels``.

    An unlisted value has a NULL rank and sorts last.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    return (counts.withColumn(rank_col, rank_of(column, levels))
            .orderBy(F.col(rank_col).asc_nulls_last(), F.desc("count"), column))


def subgroup_counts(df: DataFrame, outer: str, inner: str, order_col: str = "type_mean") -> DataFrame:
    """Counts per (outer, inner) with the outer category's mean sub-group count.

    The mean (not the total) orders the outer categories, largest first. The
    window runs over the aggregated rows, one partition per category.
    """
    counts = df.groupBy(outer, inner).count()
    mean = F.avg("count").over(Window.partitionBy(outer))
    return (counts.withColumn(order_col, mean)
            .orderBy(F.desc(order_col), F.asc_nulls_last(outer), F.asc_nulls_last(inner)))


def shares(df: DataFrame, specs: Sequence[tuple[str, str, Sequence[str]]], digits: int = 1) -> DataFrame:
    """Percent of non-NULL values in a set, one column per ``(name, column, values)``.

    All shares come from one aggregate; each ignores rows where its own column
    is NULL, rounded half to even.
    """
    aggs = []
    for name, column, values in specs:
        c = F.col(column)
        hit = F.when(c.isNotNull(), c.isin(*values).cast("int"))
        aggs.append(round_half_even(F.avg(hit) * F.lit(100.0), digits).alias(name))
    return df.agg(*aggs)


def means(df: DataFrame, columns: Sequence[str], prefix: str = "mean_", suffix: str = "",
          digits: int | None = None) -> DataFrame:
    """NULL-skipping means of several columns in one aggregate."""
    out = []
    for c in columns:
        m = F.avg(F.col(c).cast("double"))
        out.append((round_half_even(m, digits) if digits is not None else m).alias(f"{prefix}{c}{suffix}"))
    return df.agg(*out)


#: Bins to a power of two in which values are counted first, and parts of a bin in which they are counted next.
_PER_OCTAVE, _PARTS = 1 << 12, 1 << 20


#: The levels of the selection over ``counted``, rows of (``_c``: which column, ``_x``, ``_n``: how often,
#: ``_bin``). Each ``..._ranked`` has the values below a bin in ``_before``, and the next keeps the bins that
#: hold a middle rank, ``_low`` or ``_high``.
_LEVELS = f"""
    bins AS (SELECT _c, _bin, sum(_n) AS _n, min(_x) AS _lo, max(_x) AS _hi FROM counted GROUP BY _c, _bin),
    bins_ranked AS (
        SELECT *, sum(_n) OVER (PARTITION BY _c ORDER BY _bin) - _n AS _before, (sum(_n) OVER (PARTITION BY _c) - 1) DIV 2 AS _low,
               sum(_n) OVER (PARTITION BY _c) DIV 2 AS _high FROM bins),
    in_bin AS (
        SELECT c._c, c._bin, c._x, c._n, f._before AS _base, _low, _high,
               CASE WHEN _hi > _lo AND _hi - _lo < double('infinity')
                    THEN CAST(floor((c._x - _lo) / (_hi - _lo) * {_PARTS - 1}) AS BIGINT) ELSE 0 END AS _part
        FROM counted c JOIN bins_ranked f ON c._c = f._c AND c._bin = f._bin WHERE f._before <= _high AND f._before + f._n > _low),
    parts AS (SELECT _c, _bin, _part, _base, _low, _high, sum(_n) AS _n FROM in_bin GROUP BY _c, _bin, _part, _base, _low, _high),
    parts_ranked AS (SELECT *, _base + sum(_n) OVER (PARTITION BY _c, _bin ORDER BY _part) - _n AS _before FROM parts),
    in_part AS (
        SELECT v._c, v._x, v._n, v._low, v._high,
               f._before + sum(v._n) OVER (PARTITION BY v._c, v._bin, v._part ORDER BY v._x) - v._n AS _before
        FROM in_bin v JOIN parts_ranked f ON v._c = f._c AND v._bin = f._bin AND v._part = f._part
        WHERE f._before <= f._high AND f._before + f._n > f._low)
    SELECT _c, (min(_x) + max(_x)) / 2 AS _m FROM in_part WHERE _before <= _high AND _before + _n > _low GROUP BY _c"""


def _octave_bin(x: str) -> str:
    """A whole number that rises with ``x``: ``_PER_OCTAVE`` bins to each power of two, on either side of 0."""
    size = f"floor(least(log2(abs({x})), 1100.0D) * {_PER_OCTAVE}) + {1100 * _PER_OCTAVE}"
    return f"CAST(CASE WHEN {x} = 0 THEN 0 WHEN {x} < 0 THEN -({size}) ELSE {size} END AS BIGINT)"


def medians(df: DataFrame, columns: Sequence[str], prefix: str = "median_",
            digits: int | None = None, approx: bool = False, accuracy: int = 100_000) -> DataFrame:
    """NULL-skipping medians of several columns in one pass over the rows.

    Exact by default (the mean of the two middle values when the count is
    even), by radix selection. The rows are reduced to counted distinct values
    (combined per map task, so a hot value is one row a task). These are
    counted by the leading part of a whole number that rises with the value;
    the bins that hold the middle ranks are counted again in finer parts, and
    only the values of the last part are put in order. A bin is split into a
    fixed number of parts at each step, so no window and no task grows with
    the number of values: at most ``_PARTS`` doubles lie in one part.
    ``approx=True`` returns a sketch's answer, an observed value whose rank
    error is at most ``1 / accuracy``.
    """
    def named(m, c):
        return (round_half_even(m, digits) if digits is not None else m).alias(f"{prefix}{c}")

    xs = {c: F.col(c).cast("double") for c in columns}
    if approx:
        return df.agg(*[named(F.percentile_approx(x, 0.5, accuracy), c) for c, x in xs.items()])
    each = F.array(*[F.struct(F.lit(i).alias("_c"), x.alias("_x")) for i, x in enumerate(xs.values())])
    values = df.select(F.inline(each))
    middle = df.sparkSession.sql(f"""
    WITH counted AS (SELECT _c, _x, count(*) AS _n, {_octave_bin("_x")} AS _bin FROM {{values}} WHERE _x IS NOT NULL GROUP BY _c, _x),
    {_LEVELS}""", values=values)
    return middle.agg(*[named(F.max(F.when(F.col("_c") == i, F.col("_m"))), c) for i, c in enumerate(xs)])
