"""Operators for people who explore the tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from pitchlake.session import scratch
from pitchlake.sinks.writers import write_table

PREVIEW_ROWS = 20
SAMPLE_VALUES = 3
# Ranks of a key that are compared in one group.
RANKS = 65_536


def matching(df: DataFrame, equal: Mapping[str, object]) -> DataFrame:
    """Rows that equal every given value."""
    for column, value in equal.items():
        df = df.filter(F.col(column) == value)
    return df


def default_filters(df: DataFrame, tagged: Sequence[str]) -> list[str]:
    """Columns offered for filtering: the tagged ones, else all."""
    return list(tagged) or df.columns


def preview(df: DataFrame, equal: Mapping[str, object], order: Sequence[Column],
            rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows among those that match."""
    return matching(df, equal).orderBy(*order).limit(rows)


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def profile(df: DataFrame, samples: int = SAMPLE_VALUES,
            descriptions: Mapping[str, str] | None = None) -> DataFrame:
    """Per column: type, description and its smallest distinct values.

    Each further value is the minimum above the last one found, so every pass is a plain
    aggregate of the columns, one row comes back from it, and no distinct values are
    gathered anywhere.
    """
    types, descriptions = dict(df.dtypes), descriptions or {}
    found: list[dict] = []

    def above(name: str) -> Column:
        value = F.col(name)
        if not found:
            return value
        return F.when(value > F.lit(found[-1][name]).cast(types[name]), value)

    for _ in range(samples - 1):
        found.append(df.agg(*[F.min(above(c)).alias(c) for c in df.columns]).first().asDict())
    last = df.agg(*[F.min(above(c)).alias(c) for c in df.columns])
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.lit(types[c]).alias("type"),
                 F.lit(descriptions.get(c)).cast("string").alias("description"),
                 F.concat_ws(", ", *[F.lit(m[c]).cast(types[c]).cast("string") for m in found],
                             F.col(c).cast("string")).alias("sample_values"))
        for c in df.columns]))
    return last.select(rows.alias("r")).select("r.*")


def records_delta(df: DataFrame, as_of: Column, date: str | None = "date",
                  days: int = 7) -> DataFrame:
    """Number of records and of those dated within the last days; no date, no delta."""
    recent = F.lit(None).cast("long")
    if date in df.columns:
        recent = F.count_if(F.col(date) > F.date_sub(as_of, days))
    return df.agg(F.count("*").alias("records"), recent.alias("delta"))


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of rows added, removed, and changed by column, between two builds.

    NULL keys are keys. Equal rows of both sides cancel out, copy by copy. What is left of a
    key is ranked by its values on either side; rows of equal rank are compared column by
    column, and the surplus of one side counts as added or removed.

    Rows cancel by a 128-bit hash, so whole rows are moved only where a difference is left. A
    key with one row on either side is compared at once. The rows of other keys are runs of
    ranks, one for all copies of a row, and runs are compared where they overlap.
    """
    spark = old.sparkSession
    common = [c for c in old.columns if c in new.columns and c not in keys]
    columns = [*keys, *common]
    kinds = {f.name: f.dataType for f in old.select(columns).union(new.select(columns)).schema}

    def side(df: DataFrame, sign: int) -> DataFrame:
        same = df.select(*[F.col(c).cast(kinds[c]) for c in columns])
        return same.select("*", F.xxhash64(F.lit(0), *common).alias("__h"),
                           F.xxhash64(F.lit(1), *common).alias("__i"), F.lit(sign).alias("__n"))

    before, after = side(old, -1), side(new, 1)
    marks = [*keys, "__h", "__i"]
    left = (before.select(*marks, "__n").union(after.select(*marks, "__n")).groupBy(*marks)
            .agg(F.sum("__n").alias("__n")).filter("__n <> 0"))
    left = write_table(left, scratch(spark, "differences"))
    single = left.groupBy(*keys).agg(
        ((F.coalesce(F.max("__n"), F.lit(0)) <= 1) & (F.min("__n") >= -1)
         & (F.count_if(F.col("__n") > 0) <= 1) & (F.count_if(F.col("__n") < 0) <= 1))
        .alias("__single"))
    single = _renamed(single, keys)
    known = left.join(single, _matches(left, single, keys)).select(*marks, "__n", "__single")
    known = _renamed(known, [*marks, "__n"])

    def whole(df: DataFrame, sign: int) -> DataFrame:
        wanted = known.filter(F.col("__k__n") * sign > 0)
        rows = df.drop("__n").join(wanted, _matches(df, wanted, marks))
        return rows.dropDuplicates(marks).select(
            *columns, F.abs("__k__n").alias("__n"), F.lit(sign > 0).alias("__new"), "__single")

    rows = write_table(whole(before, -1).union(whole(after, 1)), scratch(spark, "changed"))
    row = F.struct(F.lit(True), *common)
    alone = rows.filter("__single").groupBy(*keys).agg(
        F.max(F.when(~F.col("__new"), row)).alias("__a"), F.max(F.when(F.col("__new"), row)).alias("__b"))
    pairs = alone.select("__a", "__b", F.lit(1).cast("long").alias("__n")).union(
        _overlaps(rows.filter("not __single").drop("__single"), keys, common))
    a, b = F.col("__a").isNotNull(), F.col("__b").isNotNull()

    def found(kind: str, column: str, condition: Column):
        return F.when(condition, F.struct(F.lit(kind).alias("kind"), F.lit(column).alias("column")))

    kinds_ = F.array(
        found("added", "*", ~a), found("removed", "*", ~b),
        *[found("changed", c, a & b & ~F.col(f"__a.{c}").eqNullSafe(F.col(f"__b.{c}")))
          for c in common])
    return (pairs.select("__n", F.inline(F.filter(kinds_, lambda k: k.isNotNull())))
            .groupBy("kind", "column").agg(F.sum("__n").alias("rows")))


def _renamed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"__k{c}" for c in columns})


def _matches(df: DataFrame, renamed: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [df[c].eqNullSafe(renamed[f"__k{c}"]) for c in columns])


def _overlaps(rows: DataFrame, keys: Sequence[str], common: Sequence[str]) -> DataFrame:
    """Pairs ``(__a, __b, __n)``: rows of both sides with ``__n`` ranks in common.

    Ranks are running counts over ranges of the sorted rows, so a hot key is shared by as many
    tasks as it has ranges. Runs are cut at every ``RANKS`` ranks and meet by key and block,
    where each position at which a run starts or ends is the start of one overlap.
    """
    n = F.col("__n")
    pieces = write_table(rows.repartitionByRange(*keys, *common).select(
        "*", F.spark_partition_id().alias("__piece")), scratch(rows.sparkSession, "pieces"))
    # Rows of a key in the pieces before; few keys lie in more than one.
    ordered = Window.partitionBy(*keys, "__new").orderBy("__piece")
    before = (pieces.groupBy(*keys, "__new", "__piece").agg(F.sum("__n").alias("__n"))
              .withColumn("__before", F.sum("__n").over(ordered) - n).filter("__before > 0"))
    before = _renamed(before.drop("__n"), [*keys, "__new", "__piece"])
    within = Window.partitionBy(*keys, "__new", "__piece").orderBy(*common or [F.lit(0)])
    until = F.col("__until") + F.coalesce("__before", F.lit(0))
    runs = (pieces.withColumn("__until", F.sum("__n").over(within.rowsBetween(
                Window.unboundedPreceding, Window.currentRow)))
            .join(before, _matches(pieces, before, [*keys, "__new", "__piece"]), "left")
            .select(*keys, "__new", F.struct(F.lit(True), *common).alias("__row"),
                    (until - n).alias("__from"), until.alias("__to")))
    size = F.lit(RANKS).cast("long")
    first, last = F.floor(F.col("__from") / size), F.floor((F.col("__to") - 1) / size)
    cut = runs.withColumn("__block", F.explode(F.sequence(first, last))).withColumns({
        "__from": F.greatest("__from", F.col("__block") * size),
        "__to": F.least("__to", (F.col("__block") + 1) * size)})
    run = F.struct(F.col("__row").alias("row"), F.col("__to").alias("to"))
    events = F.explode(F.array(
        F.struct(F.col("__from").alias("at"), F.when(~F.col("__new"), run).alias("a"),
                 F.when(F.col("__new"), run).alias("b")),
        F.struct(F.col("__to").alias("at"), F.lit(None).alias("a"), F.lit(None).alias("b"))))
    points = cut.select(*keys, "__block", events.alias("e")).select(*keys, "__block", "e.*")
    along = Window.partitionBy(*keys, "__block").orderBy("at")
    upto = along.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    swept = points.select(
        "at", F.lead("at").over(along).alias("next"),
        F.last("a", True).over(upto).alias("a"), F.last("b", True).over(upto).alias("b"))
    return swept.filter(F.col("next") > F.col("at")).select(
        F.when(F.col("a.to") > F.col("at"), F.col("a.row")).alias("__a"),
        F.when(F.col("b.to") > F.col("at"), F.col("b.row")).alias("__b"),
        (F.col("next") - F.col("at")).alias("__n"))
