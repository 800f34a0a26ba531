"""Numeric column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions._util import as_col

# A number as text: optional sign, digits with an optional fraction, optional
# exponent, surrounding blanks allowed. Java's parser alone would also take
# suffixes such as '12d'.
_NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(c) -> Column:
    """Text to DOUBLE; anything that is not a number becomes NULL."""
    c = as_col(c)
    return F.when(c.cast("string").rlike(_NUMBER_TEXT), c.cast("string").try_cast("double"))


def sum0(*cols) -> Column:
    """Row-wise sum that skips NULLs; all-NULL gives 0.0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_col(c).cast("double"), F.lit(0.0)) for c in cols])


def round_half_even(c, digits: int = 0) -> Column:
    """Round half to even (0.25 -> 0.2 at one digit)."""
    return F.bround(as_col(c), digits)


def signed_count(status, count, positive=("active", "new")) -> Column:
    """Count that is negative unless the status is one of ``positive``."""
    return F.when(as_col(status).isin(*positive), as_col(count)).otherwise(-as_col(count))
