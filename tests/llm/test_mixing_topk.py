"""Mixing sources and exact top-k search against brute force."""

from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from fieldbook.llm import mixing, topk

from .conftest import ROWS


def filled(sizes: dict, weights=(5, 2, 1), most=3) -> dict:
    """Targets by sharing out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, open_ = dict.fromkeys(order, 0.0), set(order)
    left = float(sum(sizes.values()))
    while open_ and left > 1e-9:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if target[s] + share * w[s] >= most * sizes[s]}
        if not over:
            for s in open_:
                target[s] += share * w[s]
            break
        for s in over:
            left -= most * sizes[s] - target[s]
            target[s] = most * sizes[s]
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "é", "z", "\U0001f600", None, f"s{k % 9}"]), rng.choice([0, 1, 5, 10**rng.randint(0, 5)])) for k in range(60)]
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    sizes = {s: sum(n for t, n in rows if t == s) for s, _ in rows}
    want = filled(sizes)
    assert got.keys() == want.keys()
    for s, r in got.items():
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9)
        assert r.rate == pytest.approx(want[s] / sizes[s] if sizes[s] else 0, rel=1e-9) and r.rate <= 3


def test_mixed_documents(odd, empty):
    rows = mixing.taken(odd).collect()
    assert len(rows) == len(ROWS)
    words = sorted(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in ROWS)
    assert sorted(r["size"] for r in rows) == words
    for r in rows:
        assert r.copies in (math.floor(r.rate), math.floor(r.rate) + 1) and r.copies <= 3
    assert rows == mixing.taken(odd).collect()  # drawn by hashes: the same again
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.taken(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_taken_words_come_near_their_targets(spark):
    rows = spark.range(60_000).selectExpr("id AS doc_id", "concat('s', id % 7) AS source", "repeat('w ', cast(1 + id % 13 AS int)) AS text")
    by = mixing.taken(rows).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("k")).collect()
    assert all(abs(r.k - r.t) < 0.03 * r.t for r in by)


def vectors(seed):
    rng = random.Random(seed)
    base = [rng.gauss(0, 1) for _ in range(6)]
    out = []
    for i in range(300):  # lengths far apart, near-parallel ones, ties
        s = math.exp(rng.gauss(0, 1.5))
        v = [s * (b + rng.gauss(0, 0.15)) for b in base] if i % 2 else [s * rng.gauss(0, 1) for _ in range(6)]
        out.append((i, [round(x, 2) for x in v]))
    odd = [(3, out[3][1]), (400, None), (401, [None] * 6), (402, [float("nan")] * 6), (403, [float("inf")] * 6), (404, [1.0] * 4),
           (405, []), (None, [1.0] * 6), (420, [0.0] * 6), (20, out[20][1]), *[(500 + k, out[40][1]) for k in range(60)]]
    return out + odd


@pytest.mark.parametrize("bucket, block", [(50, 16), (4096, 512), (7, 3)])
def test_top_k(spark, bucket, block):
    rows = vectors(5)
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, id string, rank int")
    sound = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (i, v) in enumerate(sound):
        if i % 20 == 0:
            scores = sorted((-sum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(sound) if a != b and len(v) == len(w))
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores[:5])]
    got = topk.top_k(df, F.col("id") % 20 == 0, k=5, bucket=bucket, block=block).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_top_k_of_little(spark):
    df = spark.createDataFrame(vectors(1)[:3], "vec_id long, embedding array<double>")
    assert topk.top_k(df, F.col("id") % 20 == 0).count() == 2
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0
