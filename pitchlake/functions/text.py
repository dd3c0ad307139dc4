"""Tokens, sentinels and tolerant casts for scraped text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def token(text: Column, index: int, sep: str = "/") -> Column:
    """``index``-th piece counted from one; NULL past the end."""
    return F.get(F.split(text, re.escape(sep)), F.lit(index - 1))


def last_token(text: Column, sep: str = "/") -> Column:
    """Last piece, trailing separators ignored."""
    trimmed = F.regexp_replace(text, f"(?:{re.escape(sep)})+$", "")
    return F.try_element_at(F.split(trimmed, re.escape(sep)), F.lit(-1))


def href_id(href: Column) -> Column:
    """Numeric id in fifth position of a profile link."""
    return token(href, 5).try_cast("int")


def to_int(text: Column) -> Column:
    """Text to int; decimals are rounded, anything unreadable is NULL."""
    whole = text.try_cast("int")
    rounded = F.round(text.try_cast("decimal(28,9)")).try_cast("int")
    return F.coalesce(whole, rounded)


def to_float(text: Column) -> Column:
    return text.try_cast("float")


def empty_to_zero(text: Column) -> Column:
    """An empty cell counts as zero while a missing one stays unknown."""
    return F.when(F.length(text) == 0, F.lit(0)).otherwise(to_int(text))


def filled_int(text: Column) -> Column:
    return F.when(F.length(text) > 0, to_int(text))


def filled_float(text: Column) -> Column:
    return F.when(F.length(text) > 0, to_float(text))


def thousands(text: Column) -> Column:
    """``45.123`` with dots as thousands marks."""
    return to_int(F.replace(text, F.lit("."), F.lit("")))


def percentage(text: Column) -> Column:
    """``55.6 %`` as a number; empty, bare sign and the text ``null`` are unknown."""
    bare = F.replace(text, F.lit("%"), F.lit(""))
    unknown = (text == "null") | (F.length(bare) == 0)
    return F.when(unknown, F.lit(None).cast("float")).otherwise(to_float(bare))


def trimmed_or_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def drop_first(text: Column, char_class: str) -> Column:
    """Remove only the first character that belongs to the class."""
    return F.regexp_replace(text, f"(?s)^(.*?){char_class}", "$1")


def squeeze(text: Column) -> Column:
    """Remove all white space."""
    return F.regexp_replace(text, r"\s+", "")


def flag(condition: Column) -> Column:
    return condition.cast("int")
