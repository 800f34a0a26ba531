"""Join building blocks.

* ``anti_join``: rows whose key is absent from the other side, against that
  side's keys, each map task's made distinct first (so a hot key there
  cannot hold one task), in a form in which AQE can split a hot key here.
* ``full_outer_join``: a full outer equi-join written as an inner join plus
  each side's rows whose key the other side lacks. Spark cannot split a skewed
  partition of a full outer join (AQE skew handling covers inner, left/right
  outer and semi/anti joins only). In this form a hot key is split by AQE on
  every part. Which keys both sides have is one aggregate over both sides'
  keys; every side is then shuffled once by its key, and that exchange serves
  the inner and the anti part. Rows with a NULL key can never match under
  ``==``: a second key, a salt that only they have, spreads them over all
  tasks (every NULL of a plain join would hash to one) and keeps the two
  sides' apart.
* no side is broadcast by hint: Spark plans from size statistics and AQE
  re-plans from measured sizes, without a job run only to count rows.
* ``null_safe_on``: join condition where NULL matches NULL, as the survey
  scripts' joins behave.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pairs(left_keys, right_keys) -> list[tuple[str, str]]:
    left_keys = [left_keys] if isinstance(left_keys, str) else list(left_keys)
    right_keys = [right_keys] if isinstance(right_keys, str) else list(right_keys)
    if len(left_keys) != len(right_keys):
        raise ValueError("left and right key lists differ in length")
    return list(zip(left_keys, right_keys))


def equi_on(pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    """Condition over differently named key columns (names must be unique)."""
    conds = [F.col(lk).eqNullSafe(F.col(rk)) if null_safe else F.col(lk) == F.col(rk)
             for lk, rk in pairs]
    return reduce(lambda a, b: a & b, conds)


def null_safe_on(left_keys, right_keys) -> Column:
    return equi_on(_pairs(left_keys, right_keys), null_safe=True)


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def anti_join(left: DataFrame, right: DataFrame, left_keys, right_keys, null_safe: bool = False) -> DataFrame:
    """Rows of ``left`` whose key is absent from ``right``.

    Only the set of right keys matters, so the right side is reduced to one
    row per key and map task. The aggregate is keyed by the task as well: so
    the join needs an exchange of its own on the keys, a plain one, and only
    below a plain exchange does AQE split a skewed join, whatever the keys'
    type. Neither side's hot key holds one task then.
    """
    pairs = _pairs(left_keys, right_keys)
    keys = right.select(*[F.col(r).alias(f"_ak{i}") for i, (_, r) in enumerate(pairs)],
                        F.spark_partition_id().alias("_task")).distinct().drop("_task")
    on = equi_on([(lk, f"_ak{i}") for i, (lk, _) in enumerate(pairs)], null_safe)
    return left.join(keys, on, "left_anti")


#: Values of the salt of rows with a NULL key.
NULL_SALTS = 1024


def null_salt(keys: Sequence[str], sign: int) -> Column:
    """0 for a whole key; else a number other than 0, of the side's sign, that spreads the rows.

    Such a row matches nothing whatever its number is, so it need not be the same when computed again. It
    is never NULL, and declared so: a join on it asks for no filter that would set two uses of a side apart.
    """
    spread = F.coalesce(F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS)), F.lit(0).cast("bigint")) + 1
    return F.when(_any_null(keys), spread * sign).otherwise(F.lit(0).cast("bigint"))


def full_outer_join(left: DataFrame, right: DataFrame, left_keys, right_keys,
                    null_safe: bool = False) -> DataFrame:
    """Full outer equi-join of two frames whose column names are disjoint.

    Result columns: all of ``left`` then all of ``right``; unmatched sides are
    NULL. With ``null_safe`` a NULL key matches a NULL key (all NULL-key pairs
    are emitted, as the join semantics require); otherwise rows with a NULL
    key are unmatched.
    """
    pairs = _pairs(left_keys, right_keys)
    lk = [p[0] for p in pairs]
    rk = [p[1] for p in pairs]
    none = F.lit(0).cast("bigint")
    left_in = left.withColumn("_ln", none if null_safe else null_salt(lk, 1))
    right_in = right.withColumn("_rn", none if null_safe else null_salt(rk, -1))
    keys = [f"_k{i}" for i in range(len(pairs))]
    stacked = [df.select(*[F.col(c).alias(k) for c, k in zip(names, keys)], F.col(salt).alias("_n"), F.lit(here).alias("_here"))
               for df, names, salt, here in ((left_in, lk, "_ln", 1), (right_in, rk, "_rn", 2))]
    both = stacked[0].unionByName(stacked[1]).groupBy(*keys, "_n").agg(F.min("_here").alias("_a"), F.max("_here").alias("_b"))
    both = both.filter(F.col("_a") < F.col("_b"))

    def lacking(df: DataFrame, names: Sequence[str], salt: str) -> DataFrame:
        on = equi_on(list(zip(names, keys)), null_safe=True) & (F.col(salt) == F.col("_n"))
        return df.join(both, on, "left_anti")

    inner = left_in.join(right_in, equi_on(pairs, null_safe=True) & (F.col("_ln") == F.col("_rn")), "inner")
    parts = [inner, lacking(left_in, lk, "_ln"), lacking(right_in, rk, "_rn")]
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*left.columns, *right.columns)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key group under ``order`` (a ``multiple = "first"`` lookup).

    ``row_number() == 1`` is planned with a partial group limit before the
    shuffle, so a key with many rows sends one row per map task.
    """
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(*order)
    return df.select("*", F.row_number().over(w).alias("_rn")).filter(F.col("_rn") == 1).select(*df.columns)
