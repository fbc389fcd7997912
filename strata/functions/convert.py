"""Tolerant conversions and formatting, as Column expressions (JVM side, codegen).

Spark 4 runs in ANSI mode, where ``cast`` of a malformed value fails the job. Every
conversion here is a ``try_*`` form: a bad value becomes NULL and the quality layer
counts it instead of the job dying on the first one.

Timestamps are wall-clock values (``timestamp_ntz``): the source text carries no zone,
and parsing it in the session's zone would shift or drop values that fall into a
daylight-saving gap (a midnight that does not exist locally). Parsing and formatting
therefore never touch the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from strata.sources.schemas import MONEY, TIMESTAMP_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c) -> Column:
    """Text -> int; malformed or out of range -> NULL."""
    return _col(c).try_cast(IntegerType())


def to_money(c) -> Column:
    """Text -> decimal(10,2); malformed or overflow -> NULL, extra digits HALF_UP."""
    return _col(c).try_cast(MONEY)


def to_timestamp(c) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` -> timestamp_ntz; anything else -> NULL.

    The text must match the pattern exactly (date only, fractional seconds, a ``T``
    separator or padding are rejected) and be a real date and time (30 Feb, hour 24
    are rejected), the same values the pattern-based ``try_to_timestamp`` rejects.
    """
    c = _col(c)
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))


def ts_text(c) -> Column:
    """Timestamp -> ``yyyy-MM-dd HH:mm:ss`` text (the inverse of ``to_timestamp``).

    A wall-clock timestamp is rendered without any zone conversion.
    """
    return F.substring(_col(c).cast("string"), 1, 19)


def month_text(c) -> Column:
    """Timestamp or date -> ``yyyy-MM`` text, without zone conversion."""
    return F.substring(_col(c).cast("string"), 1, 7)


def pct(part, whole, digits: int = 2) -> Column:
    """Percentage rounded to ``digits``; NULL when ``whole`` is 0 or NULL."""
    whole = _col(whole)
    return F.round(_col(part).cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), digits)
