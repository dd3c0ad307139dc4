"""Surrogate and composite keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Text that stands for NULL inside a hashed key, and the separator.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def surrogate_key(*columns: Column | str) -> Column:
    """md5 over the text forms of all fields, NULLs marked so that positions stay distinct."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARK))
             for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def joined_key(*columns: Column, sep: str = "|") -> Column:
    """Readable composite key; NULL when any part is NULL."""
    parts: list[Column] = []
    for column in columns:
        parts += [F.lit(sep), column.cast("string")]
    return F.concat(*parts[1:])
