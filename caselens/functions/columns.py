"""Column helpers shared by every operator. All are native, code-generated expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points that Python's str.strip() removes.
WHITESPACE = "".join(
    map(
        chr,
        (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233,
         8239, 8287, 12288),
    )
)
_WORD_BREAK = "\x01 "


def round_half(value: Column, digits: int) -> Column:
    """Round half away from zero after scaling in binary.

    ``F.round(x, n)`` rounds the decimal text of a double, so 0.285 becomes 0.29; scaling first
    gives 0.28, which is what SQL engines that round doubles natively return.
    """
    scale = F.lit(float(10**digits))
    return F.round(value.cast("double") * scale, 0) / scale


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """``part / whole`` as a double, NULL when ``whole`` is 0."""
    value = F.try_divide(part.cast("double"), whole.cast("double"))
    return value if digits is None else round_half(value, digits)


def pct(part: Column, whole: Column, digits: int) -> Column:
    """``100 * part / whole``, NULL when ``whole`` is 0."""
    return round_half(F.try_divide(F.lit(100.0) * part, whole.cast("double")), digits)


def any_of(column: Column, values) -> Column:
    """``column`` in ``values``, treating a value of None as "is NULL"."""
    values = list(values)
    tests = [column.isin([v for v in values if v is not None])]
    if None in values:
        tests.append(column.isNull())
    return reduce(lambda a, b: a | b, tests)


def calendar_days(end: Column, start: Column) -> Column:
    """Number of midnights between two instants."""
    return F.datediff(end, start).cast("bigint")


def elapsed_days(end: Column, start: Column) -> Column:
    """Fractional days between two zone-less timestamps, to the microsecond."""

    def micros_of_day(ts: Column) -> Column:
        whole = F.hour(ts) * 3600 + F.minute(ts) * 60
        return whole * F.lit(1_000_000).cast("bigint") + (
            F.date_part(F.lit("SECOND"), ts) * 1_000_000
        ).cast("bigint")

    partial = (micros_of_day(end) - micros_of_day(start)) / F.lit(86_400_000_000.0)
    return F.datediff(end, start).cast("double") + partial


def week_start(ts: Column) -> Column:
    """Monday of the week as a date."""
    return F.trunc(F.to_date(ts), "week")


def month_start(ts: Column) -> Column:
    """First day of the month as a date."""
    return F.trunc(F.to_date(ts), "month")


def weekday_name(day: Column) -> Column:
    """Three-letter English weekday."""
    return F.date_format(day, "E")


def strip_text(column: Column) -> Column:
    """NULL becomes '', surrounding whitespace of any kind is removed.

    Plain ``trim`` is much cheaper than trimming a character set, so the set is only used where some
    other kind of whitespace is left at either end.
    """
    plain = F.trim(F.coalesce(column, F.lit("")))
    special = [c for c in WHITESPACE if c != " "]
    left_over = F.substring(plain, 1, 1).isin(special) | F.substring(plain, -1, 1).isin(special)
    return F.when(left_over, F.btrim(plain, F.lit(WHITESPACE))).otherwise(plain)


def title_text(column: Column) -> Column:
    """Title case where a letter after any non-letter is upper case ("O'NEIL-RAY" -> "O'Neil-Ray").

    ``initcap`` only breaks words at spaces, so a removable break is put after other non-letters.
    """
    broken = F.regexp_replace(F.lower(column), r"([^\p{L} ])(?=\p{L})", f"$1{_WORD_BREAK}")
    return F.replace(F.initcap(broken), F.lit(_WORD_BREAK), F.lit(""))
