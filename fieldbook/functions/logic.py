"""Flags and statuses with three-valued (NULL-aware) logic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions._util import as_col


def agree_flag(a, b, yes: str = "YES", no: str = "NO") -> Column:
    """``yes`` when equal, ``no`` when different, NULL when either is NULL.

    Writing ``when(a == b, yes).otherwise(no)`` would call every missing
    comparison a disagreement.
    """
    a, b = as_col(a), as_col(b)
    return F.when(a == b, yes).when(a != b, no)


def blank_to(c, value: str, null_is_blank: bool = False) -> Column:
    """Replace an empty string (optionally also NULL) with ``value``.

    A NULL stays NULL by default: ``NULL == ''`` is unknown, so the value is
    kept, as a spreadsheet blank read as missing would be.
    """
    c = as_col(c)
    blank = (c == "") | c.isNull() if null_is_blank else c == ""
    return F.when(blank, F.lit(value)).otherwise(c)


def recode(c, mapping: dict) -> Column:
    """Map listed values, keep every other value (NULL included) as it is."""
    c = as_col(c)
    out = None
    for src, dst in mapping.items():
        out = (F.when if out is None else out.when)(c == src, F.lit(dst))
    return out.otherwise(c) if out is not None else c


def rank_of(c, levels: Sequence[str]) -> Column:
    """1-based position of the value in ``levels``; ``len(levels) + 1`` otherwise.

    Replaces an ordered factor: a value that is not listed (or missing) ranks
    after every level, as an unlisted factor value sorts last. Evaluated in
    the JVM, no dimension join needed.
    """
    pos = F.array_position(F.array(*[F.lit(v) for v in levels]), as_col(c))
    return F.when(pos > 0, pos).otherwise(F.lit(len(levels) + 1).cast("bigint"))


def level_or_null(c, levels: Sequence[str]) -> Column:
    """The value itself when listed in ``levels``, NULL otherwise."""
    c = as_col(c)
    return F.when(c.isin(*levels), c)
