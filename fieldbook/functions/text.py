"""Text column expressions with the survey scripts' string semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions._util import as_col


def trim_all(c) -> Column:
    """Strip leading and trailing white space of every Unicode kind.

    ``F.trim`` strips the blank only; tabs and no-break spaces would stay.
    """
    return F.regexp_replace(as_col(c), r"(?U)^\s+|\s+$", "")


def squeeze_first(c) -> Column:
    """Replace the *first* double space with one space.

    Only the first occurrence changes (``'a  b  c'`` -> ``'a b  c'``), which is
    what the cleaning dictionaries were keyed on.
    """
    return F.regexp_replace(as_col(c), r"(?s)^(.*?)  ", "$1 ")


def clean_text(c) -> Column:
    """Dictionary key normal form: trim, then squeeze the first double space."""
    return squeeze_first(trim_all(c))


def paste_na(*cols, sep: str = ", ") -> Column:
    """Join values with ``sep``, printing a missing value as ``NA``.

    ``concat`` would give NULL and ``concat_ws`` would skip the value.
    """
    return F.concat_ws(sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols])


def padded_id(prefix: str, c, width: int = 3, pad: str = "0") -> Column:
    """``prefix`` + the value left-padded to ``width``; longer values are kept whole.

    ``lpad`` alone would cut a value longer than ``width``.
    """
    v = as_col(c).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(v) >= width, v).otherwise(F.lpad(v, width, pad)))
