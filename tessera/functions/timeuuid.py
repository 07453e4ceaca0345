"""Version-1 (time-based) UUIDs as Spark column expressions.

Spark has no UUID type; a time UUID is kept as its canonical 36-character
string.  The 60-bit timestamp of a version-1 UUID counts 100-ns ticks since
the Gregorian reform (1582-10-15 00:00 UTC) and is spread over three hex
fields: ``time_low`` (chars 1-8), ``time_mid`` (10-13) and ``time_hi`` (16-18,
after the version nibble at 15).

All time arithmetic here is in integer microseconds since 1970 UTC, so no
result depends on the session time zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# 100-ns ticks between 1582-10-15 00:00 UTC and 1970-01-01 00:00 UTC.
GREGORIAN_OFFSET_TICKS = 122192928000000000
MICROS_PER_DAY = 86_400_000_000
MILLIS_PER_DAY = 86_400_000
# clock-sequence and node fields used when this library makes UUIDs
DEFAULT_CLOCK_NODE = "8000-000000000000"
# -----------------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def timeuuid_ticks(uuid_col) -> Column:
    """100-ns ticks since 1582-10-15 of a version-1 UUID string."""
    u = _c(uuid_col)
    hex_ts = F.concat(F.substring(u, 16, 3), F.substring(u, 10, 4), F.substring(u, 1, 8))
    return F.conv(hex_ts, 16, 10).cast("bigint")


def timeuuid_micros(uuid_col) -> Column:
    """Microseconds since 1970-01-01 UTC of a version-1 UUID string."""
    # exact floor division in integers (a double would round beyond 2**53), also before 1970
    since_epoch = timeuuid_ticks(uuid_col) - F.lit(GREGORIAN_OFFSET_TICKS)
    return F.call_function("div", since_epoch - F.pmod(since_epoch, F.lit(10)), F.lit(10))


def timeuuid_timestamp(uuid_col) -> Column:
    """The UUID's time as ``timestamp_ntz`` (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", timeuuid_micros(uuid_col), F.expr(_EPOCH_NTZ))


def ntz_micros(ts_col) -> Column:
    """Microseconds since 1970 of a ``timestamp_ntz`` column, read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts_col))


def make_timeuuid(ticks_col, clock_node: str = DEFAULT_CLOCK_NODE) -> Column:
    """canonical version-1 UUID string for the given 100-ns tick count.

    ``clock_node`` supplies the clock-sequence and node fields
    (``cccc-nnnnnnnnnnnn``); a fixed value keeps generated ids repeatable.
    """
    t = _c(ticks_col)
    time_low = F.lpad(F.lower(F.hex(t.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")
    time_mid = F.lpad(F.lower(F.hex(F.shiftright(t, 32).bitwiseAND(F.lit(0xFFFF)))), 4, "0")
    time_hi = F.lpad(F.lower(F.hex(F.shiftright(t, 48).bitwiseAND(F.lit(0x0FFF)))), 3, "0")
    return F.concat(time_low, F.lit("-"), time_mid, F.lit("-1"), time_hi, F.lit("-" + clock_node))


def as_micros(when) -> int:
    """F13/F10 helper: a Python datetime/date/ISO string as UTC micros since 1970.

    Naive datetimes are taken as UTC.  This replaces building a 'minimum UUID'
    for a time: comparing the UUID's time with a bound is the same test and
    keeps the predicate a plain integer comparison.
    """
    if isinstance(when, str):
        when = _dt.datetime.fromisoformat(when)
    if isinstance(when, _dt.date) and not isinstance(when, _dt.datetime):
        when = _dt.datetime(when.year, when.month, when.day)
    if when.tzinfo is not None:
        when = when.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    delta = when - _dt.datetime(1970, 1, 1)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def as_ticks(when) -> int:
    return as_micros(when) * 10 + GREGORIAN_OFFSET_TICKS


def ntz_literal(when) -> Column:
    """A ``timestamp_ntz`` literal for a datetime (naive = UTC wall clock)."""
    wall = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=as_micros(when))
    return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")


def created_before(uuid_col, when) -> Column:
    """P5: rows whose time UUID was made strictly before ``when``.

    The reference asks the store for ``id < minTimeuuid(now)``; that is
    ``time(id) < now`` at millisecond resolution.  ``when`` is a parameter so
    results repeat.
    """
    bound_ticks = (as_micros(when) // 1000) * 10_000 + GREGORIAN_OFFSET_TICKS
    return timeuuid_ticks(uuid_col) < F.lit(bound_ticks)


def micros_before(micros_col, when) -> Column:
    """P5 on a stored time column: the same test as :func:`created_before`.

    ``time(id) < minTimeuuid(when)`` holds exactly when the UUID's microsecond
    time is below ``when`` truncated to the millisecond.  A plain comparison
    on a numeric column is pushed to the Parquet reader.
    """
    return _c(micros_col) < F.lit((as_micros(when) // 1000) * 1000)


def midnight_micros(date_str_col, fmt: str = "yyyy-MM-dd") -> Column:
    """UTC micros since 1970 of midnight of a ``yyyy-MM-dd`` string.

    Text that is not a date raises (ANSI), as the reference's parser does.
    """
    return F.unix_date(F.to_date(_c(date_str_col), fmt)).cast("bigint") * F.lit(MICROS_PER_DAY)


def midnight_millis(date_str_col, fmt: str = "yyyy-MM-dd") -> Column:
    """Epoch milliseconds of midnight, the unit the reference compares with (Q1)."""
    return F.unix_date(F.to_date(_c(date_str_col), fmt)).cast("bigint") * F.lit(MILLIS_PER_DAY)


def made_on_or_after_day(uuid_col, date_str_col, compat: str = "correct") -> Column:
    """The UUID's time is at or after midnight of the given date.

    ``compat="raw_units"`` reproduces the reference literally: UUID ticks
    (100 ns since 1582) compared with epoch *milliseconds*, which keeps every
    modern row.
    """
    if compat == "raw_units":
        return timeuuid_ticks(uuid_col) >= midnight_millis(date_str_col)
    if compat != "correct":
        raise ValueError(f"unknown compat mode {compat!r}")
    return timeuuid_micros(uuid_col) >= midnight_micros(date_str_col)
