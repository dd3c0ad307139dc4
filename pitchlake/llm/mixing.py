"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target in words; the copies that a document of it should have on average
are the target over the size of the source. Whole copies are given to all. The fractional
ones are rounded in pairs: two documents of a source exchange words at random, each as much as
it can, until the probability of one of them is 0 or 1. The exchange keeps the expected words
of the pair and the expected copies of each document, so after all pairs a source has its
target but for one last document. Pairs are formed from the largest size down. A document that
is large against what is left would use up its partners and be left last: it is paired with
the pool of all smaller ones instead, and settled in one draw whose words the pool gives or
takes, each member in proportion to what it can. So the last document is a small one. A source
that has too few words beside a large document to make up for it is off by what is lacking.

Documents are dealt into groups of bounded size that work on their own; what is left of the
groups forms the next level of a reduction tree, until one group per source remains and its
last document is drawn by its probability. Draws are hashes of ids, so reruns agree.

Defined results: a null text has size 0 and is taken with 0 words; a source without words has
target 0; the null source is a source of its own, the last; repeated rows are mixed row by
row; an empty table gives an empty result; only the named columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.common import WORD, query, salted, settle, table, text_of

# Documents of one group.
GROUP = 4_096
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
# A document is large if the rest has less than so many times the variance it would take.
LARGE = 16.0


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """Columns source, source_size, target of one row per source.

    Weights repeat over the sources in code-point order, null last. What exceeds ``most``
    times the size of a source goes to the others by weight until none exceeds it. That ends
    where every source has the least of its limit and its weight times one level, and the
    level follows from running sums over the sources ordered by limit per weight.
    """
    everything = Window.partitionBy()
    named = sizes.withColumn("__n", F.row_number().over(
        Window.partitionBy().orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("__n") % len(weights) + 1).cast("int"))
    limit = most * F.col("source_size")
    ranked = named.withColumn("__w", weight).withColumn("__top", limit / F.col("__w"))
    order = Window.partitionBy().orderBy("__top", "__n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(
        F.sum(limit).over(before), F.lit(0.0))
    ranked = ranked.withColumn("__level", left / F.sum("__w").over(after)).withColumn(
        "__i", F.row_number().over(order))
    level = F.min(F.when(F.col("__level") <= F.col("__top"),
                         F.struct("__i", "__level"))).over(everything)["__level"]
    target = F.least(limit, F.coalesce(F.col("__w") * level, limit))
    return ranked.select("source", "source_size", target.alias("target"))


def settle_large(s: np.ndarray, p: np.ndarray, i: int, first: int, draw: float,
                 anyway: bool) -> bool:
    """Draw document i against the pool of those from ``first`` on.

    Either outcome changes the chances of the pool by opposite amounts, weighed so that every
    chance keeps its expectation and the expected words stay what they are. A pool too small
    for that gives all it can with ``anyway``, else nothing is drawn.
    """
    size, chance, pool, chances = s[i], p[i], s[first:], p[first:]
    gain, loss = (1 - chance) * size, chance * size
    room = np.minimum(chances / gain, (1 - chances) / loss)
    able = float((pool * room).sum())
    if able < 1 and not anyway:
        return False
    taken = draw < chance
    chances += (-gain if taken else loss) / max(able, 1.0) * room
    np.clip(chances, 0.0, 1.0, out=chances)
    p[i] = float(taken)
    return True


def pivot(sizes: np.ndarray, chances: np.ndarray, draws: np.ndarray, last: bool) -> np.ndarray:
    """Round chances pair by pair, from the largest size down; at most one stays fractional.

    ``sizes`` fall. With ``last`` the one left is drawn as well.
    """
    s, p = sizes.astype(float), chances.astype(float)
    empty = s == 0
    p[empty] = (draws[empty] < p[empty]).astype(float)
    held, spread, known = -1, None, -1
    for i in range(len(s)):
        if not 0 < p[i] < 1:
            continue
        if held >= 0:
            if known < 0:
                # What pairs of the rest can move at random: variances from each place on.
                spread = np.cumsum((s * s * p * (1 - p))[::-1])[::-1]
                known = i
            square = s[held] ** 2
            if LARGE * square > spread[i] and settle_large(
                    s, p, held, i, draws[held], last and square > spread[i]):
                known, held = -1, i if 0 < p[i] < 1 else -1
                continue
        if held < 0:
            held = i
            continue
        up = min((1 - p[held]) * s[held], p[i] * s[i])
        down = min(p[held] * s[held], (1 - p[i]) * s[i])
        if draws[i] * (up + down) < down:
            full, none, moved = held, i, up
        else:
            full, none, moved = i, held, down
        room, rest = (1 - p[full]) * s[full], p[none] * s[none]
        p[full] = 1.0 if moved >= room else p[full] + moved / s[full]
        p[none] = 0.0 if moved >= rest else p[none] - moved / s[none]
        held = next((j for j in (held, i) if 0 < p[j] < 1), -1)
    if last and held >= 0:
        p[held] = float(draws[held] < p[held])
    return p


def _round(rows: DataFrame, level: int, group: int) -> DataFrame:
    """One level of the reduction tree over rows with a fractional chance."""
    groups = rows.groupBy("source").agg(F.ceil(F.count("*") / group).alias("__groups"))
    dealt = rows.join(groups.withColumnRenamed("source", "__source"),
                      F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    dealt = dealt.withColumn("__group", F.pmod(
        F.xxhash64(F.lit("group"), F.lit(level), "__key"), F.col("__groups")))
    names = rows.columns

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "__key", "__row"], ascending=[False, True, True])
        draws = ((frame["__key"].to_numpy().view(np.uint64) ^ np.uint64(level + 1))
                 * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)) / float(1 << 53)
        last = bool(frame["__groups"].iloc[0] == 1)
        frame["chance"] = pivot(frame["size"].to_numpy(), frame["chance"].to_numpy(), draws, last)
        return frame[names]

    return dealt.groupBy("source", "__group").applyInPandas(work, rows.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", group: int = GROUP,
        carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, size, source_size, target, copies, taken, carried columns.

    Carried columns tell rows of one id apart and must not be null.
    """
    rows = settle(docs.select(
        *carry, F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size")), "sizes")
    aims = settle(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"))),
                  "targets")
    keyed = salted(rows, F.col("id"), group).withColumn(
        "__key", F.xxhash64(F.lit("mix"), F.col("id").cast("string"), "__salt"))
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    aim = aims.withColumnRenamed("source", "__source")
    shared = settle(keyed.join(aim, F.col("source").eqNullSafe(F.col("__source")))
                    .withColumn("whole", F.floor(rate))
                    .withColumn("chance", rate - F.floor(rate))
                    .drop("__source", "__salt"), "shares")
    done, open_, level = [shared.filter("chance = 0")], shared.filter("chance > 0"), 0
    while not open_.isEmpty():
        out = settle(_round(open_, level, group), "rounded")
        done.append(out.filter("chance <= 0 or chance >= 1"))
        open_ = out.filter("chance > 0 and chance < 1")
        level += 1
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    copies = F.col("whole") + F.round("chance").cast("long")
    return result.select(
        F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"), *carry)


@query("op9_mixing")
def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")
