"""Column expressions shared by the operators.

All of them are compositions of built-in Spark functions, so they stay
inside whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline.config import DEFAULT_PAYMENT, AirportRule, PaymentCodeRule

MICROS_PER_MINUTE = 60_000_000.0

# NULL marker used when rendering key columns to text (never produced by a cast).
NULL_MARKER = "\u0000"
KEY_SEPARATOR = "\u001f"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ, from its own fields.

    ``timestamp_diff`` and ``unix_micros`` go through the session time zone, so
    a wall-clock time inside a daylight-saving gap (02:30 on a spring-forward
    day) would move by an hour; the date/hour/minute/second fields of an NTZ
    value do not depend on any zone.
    """
    c = col(ts)
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(86_400_000_000)
        + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * F.lit(1_000_000)
        + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    )


def fractional_minutes(start: str | Column, end: str | Column) -> Column:
    """(end - start) in minutes, with microsecond precision; may be negative."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(MICROS_PER_MINUTE)


def minute_index(ts: str | Column) -> Column:
    """Minutes since 1970-01-01 00:00 of a TIMESTAMP_NTZ, time-zone independent."""
    c = col(ts)
    return (
        F.unix_date(F.to_date(c)).cast("long") * F.lit(1440)
        + F.hour(c).cast("long") * F.lit(60)
        + F.minute(c).cast("long")
    )


def minute_boundaries(start: str | Column, end: str | Column) -> Column:
    """Number of minute boundaries crossed from start to end.

    00:00:59 -> 00:01:01 counts 1 (``timestampdiff(MINUTE)`` would give 0).
    """
    return minute_index(end) - minute_index(start)


def hour_floor(ts: str | Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying TIMESTAMP_NTZ."""
    c = col(ts)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.lit(0), F.lit(0)
    )


def payment_code(c: str | Column = "payment_type", rule: PaymentCodeRule = DEFAULT_PAYMENT) -> Column:
    """Keep codes in [min, max]; anything else, NULL included, becomes ``unknown``."""
    x = col(c)
    return (
        F.when(x.between(rule.min_code, rule.max_code), x)
        .otherwise(F.lit(rule.unknown))
        .cast("short")
    )


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(col(num), F.nullif(col(den), F.lit(0)))


def sum_filled(columns, fill: float = 0.0) -> Column:
    """Left-to-right sum of columns with NULL read as ``fill``."""
    return reduce(add, [F.coalesce(col(c), F.lit(fill)) for c in columns])


def any_true(conditions) -> Column:
    return reduce(or_, list(conditions))


def is_near(a: str | Column, b: str | Column | float, eps: float = 0.02) -> Column:
    """Whether ``a`` lies within ``eps`` of ``b`` (NULL when either is)."""
    centre = F.lit(b) if isinstance(b, float) else col(b)
    return col(a).between(centre - eps, centre + eps)


def false_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def key_text(columns) -> Column:
    """Injective text rendering of a list of columns; NULL gets its own marker."""
    return F.concat_ws(
        KEY_SEPARATOR,
        *[F.coalesce(col(c).cast("string"), F.lit(NULL_MARKER)) for c in columns],
    )


def row_key(columns) -> Column:
    """Stable 128-bit hex key (32 characters) of the given columns (NULL-safe, keeps microseconds).

    The digest of an injective text rendering: equal keys <=> equal columns, up
    to a collision chance of about 1e-15 at 1e12 distinct keys. 128 bits keep the
    key half the size of a 256-bit digest on every row of bronze and the fact.
    """
    return F.md5(key_text(columns))


def airport_label(zone: str | Column, rule: AirportRule) -> Column:
    """First label whose patterns match the zone name (case-insensitive), else NULL."""
    z = col(zone)
    out = None
    for label, patterns in rule.labels:
        cond = any_true(z.ilike(p) for p in patterns)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out if out is not None else F.lit(None).cast("string")


def clamp(c: str | Column, lo: str | Column, hi: str | Column) -> Column:
    return F.greatest(F.least(col(c), col(hi)), col(lo))


def year_month(d: str | Column) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def months_touched(start: str | Column, end: str | Column) -> Column:
    """Array of 'yyyy-MM' strings of every month between two dates (both ends)."""
    seq = F.sequence(F.trunc(col(start), "MM"), F.trunc(col(end), "MM"), F.expr("interval 1 month"))
    return F.transform(seq, lambda d: F.date_format(d, "yyyy-MM"))
