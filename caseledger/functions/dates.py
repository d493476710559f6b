"""Dates and times: tolerant parsing to text or typed values, chains, ages, regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def iso_text(c: Column) -> Column:
    """``DD-MON-YYYY`` with an upper-case month as ISO text, unchecked against the calendar; "" otherwise."""
    day, mon, year = (F.regexp_extract(c, r"(\d{1,2})-([A-Z]{3})-(\d{4})", g) for g in (1, 2, 3))
    number = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), mon)
    return F.when(number > 0, F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0"))).otherwise("")


def to_date(c: Column) -> Column:
    """M/D/Y, else Y-M-D, else null."""
    return F.coalesce(F.try_to_date(c, "M/d/yyyy"), F.try_to_date(c, "yyyy-M-d"))


def military_time(c: Column) -> Column:
    """Three or four digits after ``TIME:`` as HH:MM when the hour exists; "" otherwise."""
    digits = F.lpad(F.regexp_extract(c, r"TIME:\s*(\d{3,4})\b", 1), 4, "0")
    found = F.regexp_extract(c, r"TIME:\s*(\d{3,4})\b", 1) != ""
    return F.when(found & (F.substring(digits, 1, 2).try_cast("int") < 24), F.concat_ws(":", F.substring(digits, 1, 2), F.substring(digits, 3, 2))).otherwise("")


def minutes(c: Column) -> Column:
    """Minutes since midnight of a leading H:MM, HH:MM or HHMM; null otherwise."""
    pattern = r"^\s*(\d{1,2}):?(\d{2})"
    hour, minute = F.regexp_extract(c, pattern, 1).try_cast("int"), F.regexp_extract(c, pattern, 2).try_cast("int")
    return hour * 60 + minute


def year_of(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}"), F.substring(c, 1, 4).try_cast("int"))


#: Closed bands of years (fixed values).
REGIMES = (("free_prose", 1900, 2006), ("human_error", 2007, 2009), ("ad_hoc", 2010, 2018), ("modern_six", 2019, 2100))


def regime(year: Column, bands: Sequence[tuple[str, int, int]] = REGIMES) -> Column:
    out = None
    for name, low, high in bands:
        hit = year.between(low, high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def status_by_age(day: Column, frozen: Column, done: int = 730, going: int = 183) -> Column:
    age = F.datediff(frozen, day)
    return F.when(age > done, "Completed").when(age > going, "In Progress").otherwise("Pending")


def shift_iso_dates(text: Column, days: int):
    """Every valid ISO date inside a text moved by ``days``; split at the dates, so no Python is needed."""
    pieces = F.split(text, r"(?=\d{4}-\d{2}-\d{2})")

    def move(s):
        d = F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd")
        ok = s.rlike(r"^\d{4}-\d{2}-\d{2}") & d.isNotNull()
        return F.when(ok, F.concat(F.date_format(F.date_add(d, days), "yyyy-MM-dd"), F.substr(s, F.lit(11)))).otherwise(s)

    return F.array_join(F.transform(pieces, move), "")


def chain_faults(dates: Sequence[tuple[str, str]]) -> Column:
    """Which of the (later, earlier) pairs of date columns are out of order; a missing date is no fault."""
    return F.array_compact(F.array(*[F.when(F.col(later) < F.col(earlier), f"{later}<{earlier}") for later, earlier in dates]))
