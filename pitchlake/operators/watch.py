"""Counts that are taken while a table is written, without a pass of their own.

Tasks that run again after an executor is lost may count their rows again, so a count that is
above zero says that there is something to look at; the quarantine holds the exact lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

# Texts that stand for an unknown value and are no failure to read one.
NO_VALUE = ("", "null", "-", "N/A", "?", "-:-")


class Watch:
    """Observations of the one action that writes a table."""

    def __init__(self):
        self._seen: list[tuple[str, str, Observation]] = []

    def over(self, df: DataFrame, check: str, table: str, counts: dict[str, Column]) -> DataFrame:
        """The same rows; the counts are known once they have been written."""
        seen = Observation()
        self._seen.append((check, table, seen))
        return df.observe(seen, *[count.alias(name) for name, count in counts.items()])

    def rows(self) -> list[tuple[str, str, str, int]]:
        """``(check, table, column, failures)`` after the action: a few rows per table."""
        return [(check, table, column, failures or 0) for check, table, seen in self._seen
                for column, failures in seen.get.items()]


class Cells:
    """Typed columns of a table, each with a count of the texts that could not be read."""

    def __init__(self, table: str, watch: Watch | None):
        self.table, self.watch = table, watch
        self.texts: dict[str, Column] = {}
        self.defaults: dict[str, Column] = {}

    def __call__(self, name: str, text: Column, read: Callable[[Column], Column],
                 default: int | None = None) -> Column:
        """Column for ``select``, which must get it as it is; it fills in the default."""
        self.texts[name] = text
        if default is not None:
            self.defaults[name] = F.coalesce(name, F.lit(default))
        return read(text).alias(name)

    def select(self, df: DataFrame, *columns: Column | str) -> DataFrame:
        """Columns of a table, with the counts of the cells made so far.

        Every cell is read once: its text stays beside it until it is known whether it was lost.
        """
        if not (self.watch and self.texts):
            return df.select(*columns).withColumns(self.defaults)
        texts = {name: f"__text_{name}" for name in self.texts}
        marks = {name: f"__lost_{name}" for name in self.texts}
        read = df.select(*columns, *[text.alias(texts[name]) for name, text in self.texts.items()])
        # Few values are missing: the text is only looked at where one is.
        lost = {mark: F.col(name).isNull() & F.col(texts[name]).isNotNull()
                & ~F.trim(texts[name]).isin(*NO_VALUE) for name, mark in marks.items()}
        seen = self.watch.over(read.withColumns(lost), "unreadable_cell", self.table, {
            name: F.count_if(mark) for name, mark in marks.items()})
        return seen.drop(*texts.values(), *marks.values()).withColumns(self.defaults)
