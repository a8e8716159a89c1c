"""Scalar column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from faresight.schema import MAJOR_HUBS, UT_PROGRAMME_CODE, UT_PROGRAMME_TEXT

__all__ = [
    "col_or_name", "parse_duration_minutes", "parse_ts", "iso_weekday", "lead_days",
    "clip", "row_min", "row_max", "row_mean", "count_not_null",
    "normalise_programme", "is_hub", "safe_div", "contains_or_false", "substr0",
]


def col_or_name(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Fixed format of duration texts: hours, minutes and seconds, with days in front or not.
DURATION_FORMAT = r"^(\d+\.)?\d{2}:\d{2}:\d{2}$"
# The same without a line end after the last digit: its parts stand at fixed places from the right.
DURATION_PLACES = r"^(\d+\.)?\d{2}:\d{2}:\d{2}\z"


def parse_duration_minutes(c) -> Column:
    """'HH:MM:SS' or 'D.HH:MM:SS' → whole minutes, seconds rounded half-to-even.

    Null, '' and malformed text give 0, never null: one match, then the parts by
    place; only texts that end in a line end are split.
    """
    c = col_or_name(c)

    def place(at, length=2):
        return F.substr(c, F.lit(at), length if isinstance(length, Column) else F.lit(length)).try_cast("int")

    days = F.when(F.length(c) > 9, F.coalesce(place(1, F.length(c) - 9), F.lit(0)) * 1440).otherwise(F.lit(0))
    seconds = place(-2)
    placed = days + place(-8) * 60 + place(-5) + F.when(seconds > 30, F.when(seconds < 90, 1).otherwise(2)).otherwise(0)
    parts = F.split(c, "[.:]")

    def part(i):
        return F.try_element_at(parts, F.lit(i)).try_cast("int")

    minutes = (F.coalesce(part(-4), F.lit(0)) * 1440 + part(-3) * 60 + part(-2)
               + F.bround(part(-1) / 60.0, 0).cast("int"))
    return F.coalesce(F.when(c.rlike(DURATION_PLACES), placed).when(c.rlike(DURATION_FORMAT), minutes), F.lit(0))


def parse_ts(c) -> Column:
    """ISO text 'yyyy-MM-ddTHH:mm:ss' → TIMESTAMP_NTZ; bad text → null.

    NTZ keeps hour/weekday independent of the session time zone.
    """
    return col_or_name(c).try_cast("timestamp_ntz")


def iso_weekday(ts) -> Column:
    """ISO weekday 1 = Monday … 7 = Sunday."""
    return F.weekday(col_or_name(ts)) + 1


def lead_days(dep_ts, request_ts) -> Column:
    """Fractional days between two timestamps truncated toward zero."""
    secs = F.timestamp_diff("SECOND", col_or_name(request_ts).cast("timestamp_ntz"),
                            col_or_name(dep_ts))
    return (secs / 86400.0).cast("int")


def clip(c, lo=None, hi=None) -> Column:
    """Null-preserving clip."""
    c = col_or_name(c)
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def row_min(cols) -> Column:
    """min_horizontal: skips nulls, null when all are null."""
    cols = [col_or_name(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.least(*cols)


def row_max(cols) -> Column:
    cols = [col_or_name(c) for c in cols]
    return cols[0] if len(cols) == 1 else F.greatest(*cols)


def count_not_null(cols) -> Column:
    return reduce(lambda a, b: a + b, [col_or_name(c).isNotNull().cast("int") for c in cols])


def row_mean(cols) -> Column:
    """mean_horizontal: mean of the non-null values, null when all are null."""
    cols = [col_or_name(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    n = count_not_null(cols)
    return F.when(n > 0, total / n)


def normalise_programme(c) -> Column:
    """Frequent-flyer text: first occurrence of the UT programme name → 'UT', null → '' (E2)."""
    c = col_or_name(c)
    pos = F.instr(c, UT_PROGRAMME_TEXT)
    head = F.substr(c, F.lit(1), pos - 1)
    tail = F.substr(c, pos + len(UT_PROGRAMME_TEXT))
    replaced = F.when(pos > 0, F.concat(head, F.lit(UT_PROGRAMME_CODE), tail)).otherwise(c)
    return F.coalesce(replaced, F.lit(""))


def is_hub(c) -> Column:
    """Membership in the major-hub list; null stays null."""
    return col_or_name(c).isin(MAJOR_HUBS)


def safe_div(a, b) -> Column:
    """Division that yields null instead of raising on a zero divisor."""
    return F.try_divide(col_or_name(a), col_or_name(b))


def contains_or_false(text, needle) -> Column:
    """Substring test with null → false."""
    return F.coalesce(F.contains(col_or_name(text), col_or_name(needle)), F.lit(False))


def substr0(c, offset: int, length: int) -> Column:
    """0-based slice."""
    return F.substring(col_or_name(c), offset + 1, length)
