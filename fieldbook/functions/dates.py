"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldbook.functions._util import as_col


def text_date(c) -> Column:
    """Calendar date written at the start of an ISO text (``YYYY-MM-DD...``).

    The date is the one the form recorded, in its own offset: the first ten
    characters are read, the rest (time, offset) is ignored, so a form started
    at 03:00 +05:30 on 1 Dec counts as 1 Dec, not 30 Nov in UTC. Text that is
    not a date gives NULL.
    """
    return F.try_to_date(F.substring(as_col(c).cast("string"), 1, 10), "yyyy-MM-dd")


def instant_date(c) -> Column:
    """Date of a TIMESTAMP column in the session time zone."""
    return F.to_date(as_col(c))
