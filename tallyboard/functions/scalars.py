"""Scalar helpers, all built from JVM-side functions (no Python UDFs).

Time helpers take an explicit zone and work on zone-free values, so results do
not depend on the session time zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str
UTC = "UTC"
REPORT_ZONE = "Asia/Shanghai"


def as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day(value: DateLike) -> Column:
    """A constant report date."""
    return F.lit(as_date(value))


# --- epochs and zones -------------------------------------------------------
def epoch_seconds_to_local(seconds: Column, zone: str = UTC) -> Column:
    """Wall-clock time in ``zone`` of an epoch-seconds value, as a zone-free timestamp."""
    utc = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=seconds.cast("decimal(18,6)"))
    return utc if zone == UTC else F.convert_timezone(F.lit(UTC), F.lit(zone), utc)


def epoch_millis_to_local(millis: Column, zone: str = UTC) -> Column:
    """Second-resolution wall-clock time of an epoch-milliseconds value."""
    return epoch_seconds_to_local(F.floor(millis / 1000).cast("bigint"), zone)


def epoch_millis_to_date(millis: Column, zone: str = UTC) -> Column:
    return F.to_date(epoch_millis_to_local(millis, zone))


def epoch_seconds_to_date(seconds: Column, zone: str = REPORT_ZONE) -> Column:
    return F.to_date(epoch_seconds_to_local(seconds, zone))


def local_to_epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds of a zone-free timestamp read as UTC."""
    days = F.date_diff(F.to_date(ts), F.lit(dt.date(1970, 1, 1))).cast("bigint")
    seconds = days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60
    return seconds * 1000 + F.floor(F.date_part(F.lit("SECOND"), ts) * 1000).cast("bigint")


def epoch_seconds_of_date(d: Column) -> Column:
    return F.date_diff(d, F.lit(dt.date(1970, 1, 1))).cast("bigint") * 86400


def month_key(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def first_day_at_or_after(ts: Column) -> Column:
    """The first date whose midnight is not before ``ts``."""
    return F.date_add(F.to_date(ts - F.expr("INTERVAL '0.000001' SECOND")), 1)


# --- NULLs and ratios -------------------------------------------------------
def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def share(part: Column, whole: Column) -> Column:
    """part/whole; 0 when the part is 0, NULL when only the whole is 0."""
    return (F.when(part == 0, F.lit(0.0))
            .when(whole == 0, F.lit(None).cast("double"))
            .otherwise(part / whole))


def change(now: Column, before: Column) -> Column:
    """Relative change against an earlier value, guarded like ``share``."""
    return share(now - before, before)


# --- JSON text --------------------------------------------------------------
def json_raw_token(json_text: Column, key: str) -> Column:
    """The raw token after ``"key":`` with its quotes kept; '' when the key is absent.

    ``{"status":1}`` gives ``1`` and ``{"status":"1"}`` gives ``"1"``, so the two
    stay distinguishable, which a value extract would not allow.
    """
    return F.regexp_extract(json_text, rf'"{key}":\s*("[^"]*"|[^,}}\s]+)', 1)


def json_value(json_text: Column, key: str) -> Column:
    return F.get_json_object(json_text, f"$.{key}")


# --- text -------------------------------------------------------------------
def substring_count(text: Column, piece: str) -> Column:
    """Occurrences of a literal substring."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit(""))))
                   / len(piece)).cast("int")


def nth_token(text: Column, sep: str, n: int) -> Column:
    """The n-th (1-based) token of a separated list; NULL when there is none."""
    return F.nullif(F.split_part(text, F.lit(sep), F.lit(n)), F.lit(""))


def normal_id(c: Column) -> Column:
    """Canonical text of an integer id; NULL when the text is not an integer."""
    return c.try_cast("bigint").cast("string")
