"""Scalar functions (time, numeric, text) as Column expressions.

Time values are kept as ``timestamp_ntz`` so results do not depend on the
session time zone; epoch-millisecond conversions go through
``timestampadd``/``timestampdiff`` against the NTZ epoch for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds (long) -> timestamp_ntz (UTC wall clock)."""
    return F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))


def ts_to_epoch_ms(ts) -> Column:
    """timestamp_ntz -> epoch milliseconds (long), truncating sub-ms digits."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(ts))


def now_ms() -> Column:
    """Current epoch milliseconds (processing time)."""
    return F.unix_millis(F.current_timestamp())


def hhmmss(ts) -> Column:
    """Wall clock ``HH:mm:ss`` of a timestamp."""
    return F.date_format(_c(ts), "HH:mm:ss")


def fmt_decimals(x, places: int = 2) -> Column:
    """Fixed-point text with ``places`` decimals (``%.2f``)."""
    return F.format_string(f"%.{places}f", _c(x))


def safe_long(x) -> Column:
    """Text -> long, NULL when it does not parse (never raises)."""
    return _c(x).try_cast("bigint")


def safe_double(x) -> Column:
    """Text -> double, NULL when it does not parse (never raises)."""
    return _c(x).try_cast("double")


def bool_to_number(b) -> Column:
    """Boolean -> 1.0 / 0.0."""
    return _c(b).cast("double")


def bit_to_bool(bit) -> Column:
    """0/1 bit -> boolean."""
    return _c(bit).cast("boolean")


def truncating_scale(x, factor: float) -> Column:
    """``int(x * factor)``: scale and truncate toward zero."""
    return (_c(x) * F.lit(factor)).cast("int")


def clock_mod(ts, modulus: int = 65535) -> Column:
    """Seconds since the epoch modulo ``modulus`` (a 16-bit register clock)."""
    secs = F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), _c(ts))
    return F.pmod(secs, F.lit(modulus))


WHITESPACE = " \t\n\r\f\u000b"


def trim_all(x) -> Column:
    """Strip leading and trailing ASCII whitespace (space, tab, newline,
    carriage return, form feed, vertical tab)."""
    return F.btrim(_c(x), F.lit(WHITESPACE))


def whitespace_tokens(x) -> Column:
    """Array of whitespace-separated tokens, empty tokens removed."""
    return F.filter(F.split(_c(x), r"\s+"), lambda t: t != "")


def micros(x) -> Column:
    """An amount as an exact decimal with 6 places, so sums don't depend on
    the order of addition.  Readings carry 2 or 3 decimals."""
    return _c(x).cast("decimal(24,6)")


def exact_mean(total: str, count: str) -> Column:
    """Mean of amounts summed as ``micros``: one correctly rounded division."""
    return F.col(total).cast("double") / F.col(count)


def mean_to_cents(total: str, count: str) -> Column:
    """The same mean rounded to 2 places, halves away from zero."""
    return F.round(F.col(total) / F.col(count).cast("decimal(20,0)"), 2).cast("double")
