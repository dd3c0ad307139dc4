"""Date texts in the layouts found in snapshots of different years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Weekday names before a game date, the first two-digit year of the 1900s,
# and the first season whose game dates put the day before the month.
WEEKDAYS = "Mon|Tue|Wed|Thu|Fri|Sat|Sun"
CENTURY_PIVOT = 69
DAY_FIRST_SEASON = 2024

MONTH_NAME = "MMM d, yyyy"
DAY_FIRST = "d/M/yyyy"


def first_format(text: Column, *formats: str) -> Column:
    """First layout that reads the text, else NULL."""
    return F.coalesce(*[F.try_to_date(text, f) for f in formats])


def iso_date(text: Column) -> Column:
    return text.try_cast("date")


def game_date(text: Column, day_first: Column) -> Column:
    """``Sat, 05/08/23``: the preferred order of day and month first, the other as fallback."""
    layout = rf"(?i)^(?:{WEEKDAYS}), (\d{{1,2}})/(\d{{1,2}})/(\d{{2}})$"
    day_leads, month_leads = F.lit("20$3-$2-$1"), F.lit("20$3-$1-$2")

    def read(order: Column) -> Column:
        return iso_date(F.regexp_replace(text, layout, order))

    date = F.coalesce(read(F.when(day_first, day_leads).otherwise(month_leads)),
                      read(F.when(day_first, month_leads).otherwise(day_leads)))
    centuries = (F.year(date) >= 2000 + CENTURY_PIVOT).cast("int")
    return F.add_months(date, centuries * -1200)


def era_date(text: Column, season: Column, always_day_first: Column,
             switch: int = DAY_FIRST_SEASON) -> Column:
    """Game date whose order of day and month depends on the season of the snapshot."""
    prefers_day = (season >= switch) | F.coalesce(always_day_first, F.lit(False))
    return F.when(text != "null", game_date(text, prefers_day))


def birth_date(text: Column) -> Column:
    """Full date in two layouts, or a bare year standing for its first day."""
    known = ~text.isin("N/A", "null", "")
    bare_year = iso_date(F.concat(text, F.lit("-01-01")))
    full = first_format(text, MONTH_NAME, DAY_FIRST)
    return F.when(known, F.when(F.length(text) == 4, bare_year).otherwise(full))


def contract_date(text: Column) -> Column:
    """``30/06/2026``, ``Jun 30, 2026`` or ``Jun, 2026`` (then the first of the month)."""
    parts = F.split(text, ",")
    month = F.nullif(F.get(parts, F.lit(0)), F.lit(""))
    year = F.trim(F.get(parts, F.lit(1)))
    month_day = F.when(month.rlike("^[a-zA-Z]{3} [0-9]+$"), month).otherwise(
        F.concat(month, F.lit(" 1")))
    named = F.try_to_date(F.concat(month_day, F.lit(", "), year), MONTH_NAME)
    numeric = text.rlike(r"^\d{2}/\d{2}/\d{4}$")
    return F.when(numeric, F.try_to_date(text, DAY_FIRST)).otherwise(named)


def clamp(date: Column, as_of: Column) -> Column:
    """Dates after ``as_of`` become ``as_of``; unknown dates stay unknown."""
    return F.when(date > as_of, as_of).otherwise(date)


def run_date(as_of: str | None = None) -> Column:
    return F.lit(as_of).cast("date") if as_of else F.current_date()
