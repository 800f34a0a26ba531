"""Randomised checks against brute force on small inputs."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldbook.operators.histogram import bin_layout, fixed_width_histogram
from fieldbook.operators.joins import full_outer_join

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@SETTINGS
@given(left=st.lists(keys, max_size=12), right=st.lists(keys, max_size=12), null_safe=st.booleans())
def test_full_outer_join_equals_spark_full_join(spark, left, right, null_safe):
    lf = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "lk int, li int")
    rf = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "rk int, ri int")
    ours = full_outer_join(lf, rf, "lk", "rk", null_safe=null_safe)
    cond = F.col("lk").eqNullSafe(F.col("rk")) if null_safe else F.col("lk") == F.col("rk")
    theirs = lf.join(rf, cond, "full")
    assert sorted(ours.collect(), key=str) == sorted(theirs.collect(), key=str)


def _brute_bins(values, width, boundary, limits):
    """Direct transcription of the bin rule, one value at a time."""
    xs = [v for v in values if v is not None and (limits is None or limits[0] <= v <= limits[1])]
    if not xs:
        return {}
    lo, hi = (limits if limits is not None else (min(xs), max(xs)))
    origin, n = bin_layout(lo, hi, width, boundary)
    edges = [origin + i * width for i in range(n + 1)]
    fuzz = 1e-8 * width
    counts = {i: 0 for i in range(n)}
    for x in xs:
        for i in range(n):
            high = edges[i + 1] + fuzz
            inside = (edges[i] - fuzz <= x <= high) if i == 0 else (edges[i] + fuzz < x <= high)
            if inside:  # right-closed bins, the first one also closed on the left
                counts[i] += 1
                break
    return counts


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(min_value=-20, max_value=120).map(float)), max_size=25),
       width=st.sampled_from([5.0, 10.0, 50.0]),
       boundary=st.sampled_from([None, 0.0]),
       limited=st.booleans())
def test_histogram_matches_brute_force(spark, values, width, boundary, limited):
    limits = (0.0, 100.0) if limited else None
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r.bin: r["count"] for r in fixed_width_histogram(df, "x", width, boundary=boundary,
                                                             limits=limits).collect()}
    assert got == _brute_bins(values, width, boundary, limits)
    assert all(not math.isnan(float(k)) for k in got)
