"""Texts on game and player sheets: scores, table positions, heights, positions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pitchlake.functions.text import drop_first, thousands, to_int, token

# Text of a game without score, label before an attendance,
# and characters to lose from the first four of a height.
NO_SCORE = "-:-"
ATTENDANCE_LABEL = "Attendance: "
HEIGHT_NOISE = r"[,‚'\s´]"

# Groups of playing positions.
POSITION_GROUPS = {
    "Attack": ("Centre-Forward", "Left Winger", "Right Winger", "Second Striker", "Attack"),
    "Defender": ("Centre-Back", "Left-Back", "Right-Back", "Defender"),
    "Midfield": ("Attacking Midfield", "Central Midfield", "Defensive Midfield",
                 "Left Midfield", "Right Midfield", "Midfield"),
    "Goalkeeper": ("Goalkeeper",),
}
NO_POSITION = "Missing"

# Competition kinds by type; others are "other".
COMPETITION_GROUPS = {
    "domestic_league": ("first_tier",),
    "domestic_cup": ("domestic_cup",),
    "international_cup": (
        "uefa_champions_league", "europa_league", "uefa_europa_conference_league_qualifiers",
        "uefa_champions_league_qualifying", "europa_league_qualifying",
        "uefa_europa_conference_league", "uefa_super_cup"),
    "national_team_competition": (
        "world_cup", "uefa_euro", "copa_america", "africa_cup_of_nations", "afc_asian_cup"),
}
OTHER_COMPETITION = "other"


def bucket(value: Column, groups: dict[str, tuple], default: str) -> Column:
    """Name of the group that lists the value."""
    name = F.lit(default)
    for group, members in groups.items():
        name = F.when(value.isin(*members), F.lit(group)).otherwise(name)
    return name


def goals(score: Column, side: int) -> Column:
    """Goals of side 1 or 2 of ``2:1``; NULL for a game without score."""
    return F.when(F.trim(score) != NO_SCORE, to_int(token(score, side, ":")))


def table_position(text: Column) -> Column:
    """``Position: 5`` is 5; empty or the text ``null`` is -1; missing stays unknown."""
    absent = text.isin("null", "")
    number = to_int(F.nullif(F.regexp_extract(text, r"\s([0-9]+)", 1), F.lit("")))
    return F.when(absent, F.lit(-1)).otherwise(number)


def attendance(text: Column) -> Column:
    return thousands(token(text, 2, ATTENDANCE_LABEL))


def height_cm(text: Column) -> Column:
    """``1,85 m`` as 185."""
    digits = drop_first(F.substring(text, 1, 4), HEIGHT_NOISE)
    return F.when(text != "null", to_int(F.trim(digits)))


def sub_position(text: Column) -> Column:
    return F.when(text == "Goalkeeper", F.lit("Goalkeeper")).otherwise(token(text, 2, " - "))
