"""Mixing sources to target weights.

Each source gets a share of the whole mix by its weight. A share that would repeat its source more
than ``most`` times stops there, and what is left over is shared out again by weight among the others
until none is above. A source's rate is its target over its size; every document is taken floor(rate)
times, and once more if a number drawn from a hash of the seed and the document's id is below the
fraction of the rate.

Sizes are counted in words over whole texts; null text has size 0. A null source is a source like any
other and comes last. Sources without words have target 0 and are not taken. Rows with the same id
draw the same number; rows with a null id draw by their text. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, in_order, text_or_empty, written

#: Weights dealt out to the sources in order, again and again, and how often a document may be repeated.
WEIGHTS, MOST = (5, 2, 1), 3


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, ``source_size``, ``target``, ``rate``) from rows of (source, size)."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = in_order(sources, F.col("source").asc_nulls_last())
    sources = written(sources.select("source", "source_size", F.element_at(
        F.array(*map(F.lit, weights)), (F.col("at") % len(weights) + 1).cast("int")).cast("long").alias("weight")), "sources")
    stop = F.col("source_size") * most
    level, stopped = 0.0, -1
    while True:  # each round only stops more sources, so there are as many rounds as sources at most
        over = stop <= F.col("weight") * level
        total, left, free, n = sources.agg(
            F.sum("source_size"), F.sum(F.when(over, stop).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(F.when(over, 1).otherwise(0))).first()
        if n is None or n == stopped or not free:
            break
        level, stopped = (total - left) / free, n
    target = F.least(F.col("weight") * F.lit(level), stop.cast("double"))
    return sources.select("source", "source_size", target.alias("target"),
                          F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(most))))
                          .otherwise(0.0).alias("rate"))


def draw(seed: int, id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A number in [0, 1) from the document's id (its text, where the id is null)."""
    name = F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("text:"), text_or_empty(text_column)))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), name))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def copies(rate: str = "rate", drawn: str = "draw") -> Column:
    return (F.floor(rate) + F.when(F.col(drawn) < F.col(rate) - F.floor(rate), 1).otherwise(0)).cast("long")


def taken(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(doc_id, ``size``, source, ``source_size``, ``target``, ``rate``, ``copies``) of every document."""
    rows = written(docs.select("doc_id", "source", size_of().alias("size"), draw(seed).alias("draw")), "sizes")
    rates = written(targets(rows, weights, most), "rates")
    both = rows.join(rates, rows["source"].eqNullSafe(rates["source"])).drop(rates["source"])
    return both.withColumn("copies", copies()).drop("draw")


def mix(docs: DataFrame, seed: int = 0, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mixed documents: the rows of ``docs``, each as often as it is taken."""
    rates = written(targets(docs.select("source", size_of().alias("size")), weights, most), "rates").select(
        F.col("source").alias("mix source"), F.col("rate").alias("mix rate"))
    rows = docs.withColumn("mix draw", draw(seed))
    rows = rows.join(rates, F.col("source").eqNullSafe(F.col("mix source")))
    rows = rows.withColumn("mix copies", copies("mix rate", "mix draw")).where(F.col("mix copies") > 0)
    rows = rows.withColumn("mix copy", F.explode(F.sequence(F.lit(1), F.col("mix copies"))))
    return rows.select(docs.columns)
