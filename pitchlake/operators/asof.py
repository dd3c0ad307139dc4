"""As-of join: the last known state at or before a point in time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Grain = Callable[[Column], Column]

# Grains from coarse to fine. The number of distinct points within the finest is bounded:
# 366 dates in a year, 60 million microseconds in a minute.
DATE_GRAINS: tuple[Grain, ...] = (lambda t: F.year(t),)
TIMESTAMP_GRAINS: tuple[Grain, ...] = (
    lambda t: F.date_trunc("day", t),
    lambda t: F.date_trunc("minute", t),
)


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
              payload: Sequence[str], tie: Sequence[Column],
              grains: Sequence[Grain] = DATE_GRAINS) -> DataFrame:
    """Left rows with the payload of the key's last right row not later than the left time.

    The last row wins whole, a NULL in its payload included. ``tie`` orders right rows of
    the same key and time, the greatest wins.

    Points are first reduced to one per key and time, within each input task, so copies of
    a point cost nothing. Then a window per key and grain of time carries the last state
    forward, and each starts from the state that the grains before it have left, one row a
    grain: no task ever holds all points of a hot key.
    """
    state = F.struct(*[F.col(c) for c in payload])
    empty = F.lit(None).cast(right.select(state.alias("s")).schema["s"].dataType)
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(tie)])
    asked = left.select(
        F.col(key).alias("k"), F.col(left_time).alias("t"),
        F.lit(True).alias("wanted"), empty.alias("state"), F.lit(None).alias("rank"))
    known = right.select(
        F.col(key).alias("k"), F.col(right_time).alias("t"),
        F.lit(False).alias("wanted"), state.alias("state"), rank.alias("rank"))
    points = asked.unionByName(known).filter(F.col("k").isNotNull() & F.col("t").isNotNull())

    names = [f"g{i}" for i in range(len(grains))]
    points = points.withColumns({
        name: grain(F.col("t")) for name, grain in zip(names, grains)})
    single = points.groupBy("k", *names, "t").agg(
        F.max("wanted").alias("wanted"), F.max_by("state", "rank").alias("state"))
    upto = Window.partitionBy("k", *names).orderBy("t").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    answers = single.withColumn("state", F.last("state", ignorenulls=True).over(upto))
    if names:
        incoming = _starts(_ends(single, names), names)
        answers = answers.join(incoming, ["k", *names], "left").withColumn(
            "state", F.coalesce("state", "incoming"))

    answers = answers.filter("wanted").select(
        F.col("k").alias(key), F.col("t").alias(left_time), "state")
    matched = left.join(answers, [key, left_time], "left")
    others = [c for c in left.columns if c not in payload]
    return matched.select(*others, *[F.col("state")[c].alias(c) for c in payload])


def _ends(single: DataFrame, grains: list[str]) -> DataFrame:
    """State at the end of every group, and whether a point is wanted in it."""
    known = F.when(F.col("state").isNotNull(), F.col("t"))
    return single.groupBy("k", *grains).agg(
        F.max("wanted").alias("wanted"), F.max_by("state", known).alias("state"))


def _starts(ends: DataFrame, grains: list[str]) -> DataFrame:
    """Carry the states at the ends of groups to the starts of later ones."""
    *outer, finest = ["k", *grains]
    before = Window.partitionBy(*outer).orderBy(finest).rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.withColumn("incoming", F.last("state", ignorenulls=True).over(before))
    if len(grains) > 1:
        known = F.when(F.col("state").isNotNull(), F.col(finest))
        coarser = ends.groupBy(*outer).agg(
            F.max("wanted").alias("wanted"), F.max_by("state", known).alias("state"))
        above = _starts(coarser, grains[:-1]).withColumnRenamed("incoming", "earlier")
        starts = starts.join(above, outer, "left").withColumn(
            "incoming", F.coalesce("incoming", "earlier"))
    return starts.filter("wanted").select("k", *grains, "incoming")
