"""Cleaning dictionaries: first-match lookup, feedback and compaction.

A dictionary maps a raw text key to clean values and carries an ``ord``
column, its row position: when a key is listed more than once, the row with
the lowest ``ord`` wins. Rows appended by feedback are placed after all
listed rows.

Keys in the data are normalised the way the dictionaries were keyed: trimmed
of white space, first double space squeezed. A NULL key matches a NULL
dictionary key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.functions import clean_text
from fieldbook.operators.joins import first_per_key


@dataclass(frozen=True)
class Lookup:
    """One dictionary applied to one data column."""

    column: str                      # raw text column in the data
    dictionary: DataFrame
    key: str | None = None           # dictionary key column (default: ``column``)
    values: Sequence[str] = field(default_factory=tuple)  # default: all but key and order
    order: str = "ord"

    @property
    def key_col(self) -> str:
        return self.key or self.column

    @property
    def value_cols(self) -> list[str]:
        if self.values:
            return list(self.values)
        return [c for c in self.dictionary.columns if c not in (self.key_col, self.order)]


def first_match(dictionary: DataFrame, key: str, values: Sequence[str], order: str = "ord") -> DataFrame:
    """One row per key: the values of its lowest-``ord`` row.

    Ties (two unnumbered rows) are broken by the values, so the result is
    deterministic.
    """
    ordering = [F.col(order).asc_nulls_last()] + [F.col(v).asc_nulls_last() for v in values]
    return first_per_key(dictionary.select(key, *values, order), [key], ordering)


def _attach(df: DataFrame, column: str, deduped: DataFrame, key: str,
            outputs: dict[str, str]) -> DataFrame:
    """Null-safe left join of ``df[column]`` to a first-match dictionary."""
    side = deduped.select(F.col(key).alias("_dk"), *[F.col(v).alias(o) for v, o in outputs.items()])
    return df.join(side, F.col(column).eqNullSafe(F.col("_dk")), "left").select(*df.columns, *outputs.values())


def standardize(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Normalise each raw column and attach its dictionary's clean values.

    Every dictionary is reduced to one row per key first, so the lookup can
    neither drop nor multiply data rows. Dictionaries are joined as Spark's
    size statistics and AQE see fit.
    """
    raw = {lk.column for lk in lookups}
    out = df.select(*[clean_text(c).alias(c) if c in raw else F.col(c) for c in df.columns])
    for lk in lookups:
        deduped = first_match(lk.dictionary, lk.key_col, lk.value_cols, lk.order)
        out = _attach(out, lk.column, deduped, lk.key_col, {v: v for v in lk.value_cols})
    return out


def standardize_roles(df: DataFrame, dictionary: DataFrame, roles: Sequence[str],
                      key: str = "business_type", value: str = "business_type_clean",
                      order: str = "ord") -> DataFrame:
    """One dictionary applied to several columns (``role`` -> ``role_clean``).

    The deduplicated dictionary is built once and shared by the role joins
    (its exchange or broadcast is reused).
    """
    deduped = first_match(dictionary, key, [value], order)
    out = df.select(*[clean_text(c).alias(c) if c in roles else F.col(c) for c in df.columns])
    for role in roles:
        out = _attach(out, role, deduped, key, {value: f"{role}_clean"})
    return out


def _values(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _merge_pairs(dictionary: DataFrame, pairs: DataFrame, key: str, values: list[str], order: str) -> DataFrame:
    """Dictionary plus new (key, values) rows, sorted by key; no blank keys; one row per pair.

    A pair already listed keeps its lowest position. A new pair is placed
    after every listed row (``max + 1``, read as one number); new pairs have
    distinct keys, so they never tie within a key. ``key != ''`` also drops
    NULL keys.
    """
    order_type = dict(dictionary.dtypes)[order]
    top = dictionary.agg(F.max(order)).first()[0]
    new = pairs.select(F.lit(0 if top is None else top + 1).cast(order_type).alias(order), key, *values)
    merged = dictionary.select(order, key, *values).unionByName(new)
    return (merged.filter(F.col(key) != "")
            .groupBy(key, *values).agg(F.min(order).alias(order))
            .select(order, key, *values).orderBy(key, order))


def dictionary_feedback(df: DataFrame, dictionary: DataFrame, key: str, value: str | Sequence[str],
                        order: str = "ord") -> DataFrame:
    """Dictionary extended with every data key that got no clean value.

    ``value`` is the clean column (or all value columns, the first being the
    clean one). New rows carry NULL values for a person to fill in. Keys whose
    first match has a NULL value are already listed and are not added twice.
    """
    values = _values(value)
    missing = df.filter(F.col(values[0]).isNull()).select(key, *values).distinct()
    return _merge_pairs(dictionary, missing, key, values, order)


def compact_dictionary(df: DataFrame, dictionary: DataFrame, roles: Sequence[str],
                       key: str = "business_type", value: str = "business_type_clean",
                       order: str = "ord", include_unmatched: bool = False) -> DataFrame:
    """Dictionary merged with the matched pairs of several roles, deduplicated.

    By default only pairs with a clean value are merged (they come from the
    dictionary), so this drops blank keys and duplicate pairs and adds
    nothing new. With ``include_unmatched`` the role values without a clean
    value are fed back too, as ``dictionary_feedback`` does for one column.
    """
    pairs = reduce(lambda a, b: a.unionByName(b), [
        df.select(F.col(r).alias(key), F.col(f"{r}_clean").alias(value)) for r in roles])
    if not include_unmatched:
        pairs = pairs.filter(F.col(value).isNotNull())
    return _merge_pairs(dictionary, pairs.distinct(), key, [value], order)
