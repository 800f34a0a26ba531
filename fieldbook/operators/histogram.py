"""Fixed-width histograms with the report's bin rule.

Bins are right-closed, ``(lo, hi]``, except the first, which also holds its
lower edge. The first edge (the origin) is ``boundary + floor((min -
boundary) / width) * width``, where ``min`` is the lower limit when limits
are given and the data minimum otherwise; without an explicit boundary the
bins are centred on multiples of the width (``boundary = width / 2``). With
limits, values outside them are removed before binning. A value within
``1e-8 * width`` above an edge still belongs to the bin below it.

Every value's bin is numbered from the boundary, so one pass counts the rows
of each (group, bin) without knowing the range. All else is made from these
counts: the first bin and, between neighbouring occupied bins (of any group),
the empty ones, which every group present lists with count 0. A gap of more
than ``LONGEST_GAP`` bins lies beside a value that is no part of the picture
(a mistyped one) and is left out; the bins on either side of it are as they
would be alone. With limits the bins are those of the axis, all of them.
Neither rule depends on how wide the data's range is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_FUZZ = 1e-8

#: Empty bins in a row that are listed; bins of an axis unrolled at a time.
LONGEST_GAP, _STEP = 10_000, 1_000


def bin_layout(lo: float, hi: float, width: float, boundary: float | None = None) -> tuple[float, int]:
    """(origin, number of bins) covering ``[lo, hi]``."""
    if boundary is None:
        boundary = width / 2
    origin = boundary + math.floor((lo - boundary) / width) * width
    n_bins = max(1, math.floor((hi - origin) / width + 1 - _FUZZ))
    return origin, n_bins


def _between(occupied: DataFrame) -> DataFrame:
    """The empty bins between neighbours of distinct ``_at``, where no more than ``LONGEST_GAP`` lie between.

    A bin's next neighbour within that reach lies in the same block of bins, or is the first of the next
    block; so no window spans more than a block.
    """
    blocks = occupied.select("_at", F.floor(F.col("_at") / (LONGEST_GAP + 1)).alias("_block"))
    inside = F.lead("_at").over(Window.partitionBy("_block").orderBy("_at"))
    firsts = blocks.groupBy("_block").agg(F.min("_at").alias("_first")).withColumn("_block", F.col("_block") - 1)
    near = blocks.withColumn("_inside", inside).join(firsts, "_block", "left")
    gap = near.select("_at", F.coalesce("_inside", "_first").alias("_next"))
    gap = gap.filter((F.col("_next") - F.col("_at")).between(2, LONGEST_GAP + 1))
    return gap.select(F.explode(F.sequence(F.col("_at") + 1, F.col("_next") - 1)).alias("_at"))


def fixed_width_histogram(df: DataFrame, value: str, width: float, group: str | None = None,
                          boundary: float | None = None,
                          limits: tuple[float, float] | None = None) -> DataFrame:
    """Counts per (group, bin): columns ``[group,] bin, xmin, xmax, count``, bins numbered from the first."""
    width = float(width)
    boundary = width / 2 if boundary is None else float(boundary)
    x = F.col(value).cast("double")
    data = df.filter(x.isNotNull())
    if limits is not None:
        data = data.filter(x.between(float(limits[0]), float(limits[1])))
    # Without a group, one constant group, which is there only when some value survived the filters.
    key = group or "_all"
    data = data.select(F.col(group) if group else F.lit(0).alias(key), ((x - F.lit(boundary)) / F.lit(width)).alias("_x"))
    at = (F.ceil(F.col("_x") - F.lit(_FUZZ)) - 1).cast("bigint")
    zero = F.lit(0).cast("bigint").alias("_w")
    # the first bin is the one that starts at or below the least value (or the lower limit)
    if limits is not None:
        first = math.floor((float(limits[0]) - boundary) / width)
        last = first + bin_layout(float(limits[0]), float(limits[1]), width, boundary)[1] - 1
        axis = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"), F.lit(_STEP).cast("bigint"))
        last_bin = F.lit(last).cast("bigint")
        steps = data.select(key).distinct().select(key, F.explode(axis).alias("_from"))
        grid = steps.select(key, F.explode(F.sequence("_from", F.least(F.col("_from") + _STEP - 1, last_bin))).alias("_at"), zero)
        cells = data.select(key, F.least(at, last_bin).alias("_at"), F.lit(1).cast("bigint").alias("_w")).unionByName(grid)
        cells = cells.withColumn("_first", F.lit(first).cast("bigint"))
    else:
        counts = data.groupBy(key, at.alias("_at")).agg(F.count(F.lit(1)).alias("_w"), F.min("_x").alias("_low"))
        occupied = counts.select("_at").distinct()
        listed = occupied.unionByName(_between(occupied))
        grid = counts.select(key).distinct().join(listed).select(key, "_at", zero)  # the result's own rows
        least = counts.agg(F.floor(F.min("_low")).cast("bigint").alias("_first"))
        cells = counts.select(key, "_at", "_w").unionByName(grid).join(F.broadcast(least))  # one row
    # a value on the lowest edge belongs to the first bin, as all others at or below it would
    cells = cells.groupBy(key, F.greatest("_at", "_first").alias("_at")).agg(F.min("_first").alias("_first"), F.sum("_w").cast("bigint").alias("count"))
    number = F.col("_at") - F.col("_first")
    xmin = F.lit(boundary) + F.col("_first").cast("double") * F.lit(width) + number.cast("double") * F.lit(width)
    return cells.select(*([key] if group else []), number.alias("bin"), xmin.alias("xmin"),
                        (xmin + F.lit(width)).alias("xmax"), "count")
