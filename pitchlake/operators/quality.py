"""Declarative data checks.

Rules on single rows of one table are measured together in one aggregation. All other
checks return their failing rows; ``verdict`` turns those into one metric row.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pitchlake.operators.contract import Contract, ForeignKey, column_differences
from pitchlake.session import scratch
from pitchlake.sinks.writers import write_table

REPORT = "check string, table string, column string, severity string, failures bigint, detail string"


@dataclass(frozen=True)
class Rule:
    """A rule measured by one aggregate. ``failures`` and ``detail`` are aggregate columns."""
    check: str
    column: str
    failures: Column
    detail: Column | None = None
    severity: str = "error"


def not_null(column: str, severity: str = "error") -> Rule:
    return Rule("not_null", column, F.count_if(F.col(column).isNull()), severity=severity)


def accepted_values(column: str, values: Iterable) -> Rule:
    return Rule("accepted_values", column, F.count_if(~F.col(column).isin(*values)))


def values_not_in(column: str, values: Iterable) -> Rule:
    return Rule("values_not_in", column, F.count_if(F.col(column).isin(*values)))


def values_between(column: str, low=None, high=None) -> Rule:
    """Bounds may be constants or column expressions; an absent bound is open."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < low)
    if high is not None:
        outside = outside | (F.col(column) > high)
    return Rule("values_between", column, F.count_if(outside))


def missing_share(column: str, tolerance: float) -> Rule:
    total = F.count("*")
    share = F.try_divide(total - F.count(column), total)
    return Rule("missing_share", column,
                F.coalesce((share > tolerance).cast("long"), F.lit(0)),
                F.format_string("%.4f", share))


def row_count_between(low: int, high: int) -> Rule:
    total = F.count("*")
    return Rule("row_count", "*", (~total.between(low, high)).cast("long"), total.cast("string"))


def measure(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of a table by one scan and one aggregation, one report row per rule."""
    aggregates = []
    for i, rule in enumerate(rules):
        aggregates.append(rule.failures.cast("long").alias(f"f{i}"))
        detail = rule.detail if rule.detail is not None else F.lit(None)
        aggregates.append(detail.cast("string").alias(f"d{i}"))
    rows = F.explode(F.array(*[
        F.struct(F.lit(rule.check).alias("check"), F.lit(table).alias("table"),
                 F.lit(rule.column).alias("column"), F.lit(rule.severity).alias("severity"),
                 F.col(f"f{i}").alias("failures"), F.col(f"d{i}").alias("detail"))
        for i, rule in enumerate(rules)]))
    return df.agg(*aggregates).select(rows.alias("r")).select("r.*")


def verdict(failing: DataFrame, check: str, table: str, column: str,
            severity: str = "error") -> DataFrame:
    """One metric row for a check that returns failing rows."""
    return failing.agg(F.count("*").alias("failures")).select(
        F.lit(check).alias("check"), F.lit(table).alias("table"), F.lit(column).alias("column"),
        F.lit(severity).alias("severity"), "failures", F.lit(None).cast("string").alias("detail"))


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL are left out."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (df.filter(complete).groupBy(*columns).agg(F.count("*").alias("occurrences"))
            .filter("occurrences > 1"))


def missing_columns(df: DataFrame, table: str, declared: Sequence[str]) -> DataFrame:
    """Metric row on declared columns the table lacks, names in the detail."""
    lacking = [c for c, kind in column_differences(df, declared) if kind == "missing"]
    return df.sparkSession.range(1).select(
        F.lit("columns_contain").alias("check"), F.lit(table).alias("table"),
        F.lit("*").alias("column"), F.lit("error").alias("severity"),
        F.lit(len(lacking)).cast("long").alias("failures"),
        F.lit(", ".join(lacking)).alias("detail"))


WHOLE = ("tinyint", "smallint", "int", "bigint")


def id_bitmaps(df: DataFrame, groups: Sequence[str], ids: Mapping[str, str]) -> DataFrame:
    """Bitmaps of whole-number ids: rows ``(groups, kind, bucket, bits)``.

    ``ids`` maps a kind to its column. A bitmap holds the ids of one bucket of 32,768
    neighbours, so each task sends one for every group and bucket it has seen, however many
    rows it has. Ids of NULL are left out, groups without any id keep a row.
    """
    kinds = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(column).cast("long").alias("id"))
        for kind, column in ids.items()]))
    rows = df.select(*groups, kinds.alias("k")).select(*groups, "k.kind", "k.id")
    return rows.groupBy(*groups, "kind", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of larger groups, from those of smaller ones."""
    return bitmaps.groupBy(*groups, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_bitmaps(bitmaps: DataFrame, groups: Sequence[str], kinds: Iterable[str]) -> DataFrame:
    """Distinct ids of every group, one column per kind."""
    return bitmaps.groupBy(*groups).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bits"))), F.lit(0)).alias(kind)
        for kind in kinds])


def distinct_ids(df: DataFrame, groups: Sequence[str], ids: Mapping[str, str]) -> DataFrame:
    """Distinct ids per group for several columns at once.

    Whole numbers are counted by bitmaps, in one pass over the rows. Other types are counted
    as Spark does it.
    """
    types = dict(df.dtypes)
    if all(types[column] in WHOLE for column in ids.values()):
        return count_bitmaps(id_bitmaps(df, groups, ids), groups, ids)
    return df.groupBy(*groups).agg(
        *[F.countDistinct(column).alias(kind) for kind, column in ids.items()])


def few_distinct(df: DataFrame, column: str, group: Column, above: int,
                 condition: Column) -> DataFrame:
    """Groups among the rows under ``condition`` with too few distinct values."""
    rows = df.filter(condition).select(group.alias("grp"), column)
    return distinct_ids(rows, ["grp"], {"distinct_values": column}).filter(
        F.col("distinct_values") <= above)


def date_gaps(df: DataFrame, column: str, part: str, start: str, end: str) -> DataFrame:
    """Date parts from ``start`` up to, not including, ``end`` without any row."""
    spark = df.sparkSession
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    spine = spark.range(1).select(F.explode(F.sequence(
        F.date_trunc(part, first).cast("date"), last,
        F.expr(f"interval 1 {part}"))).alias("period"))
    present = df.select(F.date_trunc(part, column).cast("date").alias("period")).distinct()
    return spine.filter(F.col("period") < last).join(present, "period", "left_anti")


def orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame,
            target: Sequence[str]) -> DataFrame:
    """Foreign keys without parent, with the number of rows that carry them.

    Rows are counted per key before the join, so a key on many rows is one row in it.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = child.filter(complete).groupBy(*columns).agg(F.count("*").alias("rows"))
    parents = parent.select(*[F.col(t).alias(c) for c, t in zip(columns, target)])
    return keys.join(parents, list(columns), "left_anti")


def _common_types(sides: Sequence[Sequence[str]]) -> list[str]:
    """Type in which the values of each key column compare over all sides.

    Whole numbers of any width compare as numbers; other types that differ compare as text.
    """
    def common(types: set[str]) -> str:
        if len(types) == 1:
            return next(iter(types))
        return "bigint" if types <= set(WHOLE) else "string"

    return [common(set(types)) for types in zip(*sides, strict=True)]


def key_findings(tables: Mapping[str, DataFrame], table: str, target: Sequence[str], unique: bool,
                 links: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Findings on one key and on all columns ``links`` that refer to it, by one aggregation.

    Rows ``(table, key, parent, target, failures, keys)``: for the key itself, without parent, its
    values on more than one row; for every link its rows without a parent, and their values.
    Values with a NULL are left out. Rows are counted per value within each input task, one
    counter for every side, so a value on many rows of many tables is one row per task.
    """
    sides = [(table, target), *links]
    dtypes = {name: dict(tables[name].dtypes) for name, _ in sides}
    types = _common_types([[dtypes[name][c] for c in columns] for name, columns in sides])
    names = [f"k{i}" for i in range(len(target))]
    rows = reduce(DataFrame.unionByName, [
        tables[name].filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])).select(
            *[F.col(c).cast(kind).alias(n) for c, kind, n in zip(columns, types, names, strict=True)],
            F.lit(side).alias("side"))
        for side, (name, columns) in enumerate(sides)])
    counts = rows.groupBy(*names).agg(*[
        F.count_if(F.col("side") == side).alias(f"n{side}") for side in range(len(sides))])
    lost = F.col("n0") == 0
    found = [F.count_if(F.col("n0") > 1).alias("f0"), F.lit(0).cast("long").alias("v0")]
    for side in range(1, len(sides)):
        own = F.col(f"n{side}")
        found += [F.coalesce(F.sum(F.when(lost, own)), F.lit(0)).alias(f"f{side}"),
                  F.count_if(lost & (own > 0)).alias(f"v{side}")]
    nothing = F.lit(None).cast("string")
    entries = [F.struct(
        F.lit(name).alias("table"), F.lit(",".join(columns)).alias("key"),
        (F.lit(table) if side else nothing).alias("parent"),
        (F.lit(",".join(target)) if side else nothing).alias("target"),
        F.col(f"f{side}").alias("failures"), F.col(f"v{side}").alias("keys"))
        for side, (name, columns) in enumerate(sides) if side or unique]
    return counts.agg(*found).select(F.inline(F.array(*entries)))


def key_index(tables: Mapping[str, DataFrame], unique: Mapping[str, Sequence[Sequence[str]]],
              contracts: Iterable[Contract], path: str) -> DataFrame:
    """Findings on all keys that are declared unique or take part in a relationship, stored.

    A key and all columns that refer to it are one aggregation on their own types, so no join
    is needed and a value is shuffled once, however many relationships it takes part in.
    """
    wanted: dict[tuple, dict] = {}
    for table, keys in unique.items():
        if table in tables:
            wanted |= {(table, tuple(key)): {} for key in keys}
    declared = set(wanted)
    for contract, key in _links(tables, contracts):
        wanted.setdefault((key.table, tuple(key.target)), {})[contract.name, tuple(key.columns)] = None
    return write_table(report([
        key_findings(tables, table, target, (table, target) in declared, list(links))
        for (table, target), links in wanted.items()]), path)


def _links(tables: Mapping[str, DataFrame],
           contracts: Iterable[Contract]) -> list[tuple[Contract, ForeignKey]]:
    return [(contract, key) for contract in contracts for key in contract.foreign_keys
            if contract.name in tables and key.table in tables]


def index_unique(index: DataFrame, unique: Mapping[str, Sequence[Sequence[str]]],
                 tables: Iterable[str]) -> DataFrame:
    """Report on all keys that have to be unique; keys with a NULL are left out."""
    tables = set(tables)
    declared = index.sparkSession.createDataFrame(
        [(t, ",".join(k)) for t, keys in unique.items() if t in tables for k in keys],
        "table string, key string")
    found = index.filter(F.col("parent").isNull()).select("table", "key", "failures")
    return declared.join(found, ["table", "key"], "left").select(
        F.lit("unique").alias("check"), "table", F.col("key").alias("column"),
        F.lit("error").alias("severity"), F.coalesce("failures", F.lit(0)).alias("failures"),
        F.lit(None).cast("string").alias("detail"))


def index_foreign_keys(index: DataFrame, tables: Mapping[str, DataFrame],
                       contracts: Iterable[Contract]) -> DataFrame:
    """Report on all declared relationships."""
    links = index.sparkSession.createDataFrame(
        [(c.name, ",".join(k.columns), k.table, ",".join(k.target))
         for c, k in _links(tables, contracts)],
        "table string, key string, parent string, target string")
    zero = F.lit(0).cast("long")
    return links.join(index, ["table", "key", "parent", "target"], "left").select(
        F.lit("foreign_key").alias("check"), "table", F.col("key").alias("column"),
        F.lit("error").alias("severity"), F.coalesce("failures", zero).alias("failures"),
        F.concat("parent", F.lit(": "), F.coalesce("keys", zero).cast("string"),
                 F.lit(" keys")).alias("detail"))


def foreign_keys(tables: Mapping[str, DataFrame], contracts: Iterable[Contract]) -> DataFrame:
    """Report on every declared relationship whose two tables are given."""
    parts = []
    for contract, key in _links(tables, contracts):
        lost = orphans(tables[contract.name], key.columns, tables[key.table], key.target)
        parts.append(lost.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"),
            F.count("*").alias("keys")).select(
                F.lit("foreign_key").alias("check"), F.lit(contract.name).alias("table"),
                F.lit(",".join(key.columns)).alias("column"),
                F.lit("error").alias("severity"), "failures",
                F.concat(F.lit(key.table + ": "), F.col("keys").cast("string"),
                         F.lit(" keys")).alias("detail")))
    return report(parts)


def outside_pair(facts: DataFrame, fact_value: str, games: DataFrame, key: str,
                 pair: tuple[str, str]) -> DataFrame:
    """Facts whose value is neither of the two their game names.

    A game with an unknown side is never reported, nor is a fact without game.
    """
    sides = games.select(key, *[F.col(c).alias(f"__{c}") for c in pair])
    joined = facts.join(sides, key, "left")
    return joined.filter(~F.col(fact_value).isin(*[F.col(f"__{c}") for c in pair])).select(
        *facts.columns)


def small_groups(df: DataFrame, groups: Sequence[str], condition: Column,
                 minimum: int) -> DataFrame:
    """Groups with fewer rows than expected."""
    return (df.filter(condition).groupBy(*groups).agg(F.count("*").alias("rows"))
            .filter(F.col("rows") < minimum))


def incomplete_parents(parents: DataFrame, parent_key: str, expected: str, children: DataFrame,
                       child_key: str, child_id: str) -> DataFrame:
    """Parents with fewer distinct children than expected, or with no expectation."""
    counted = (children.filter(F.col(child_key).isNotNull())
               .groupBy(F.col(child_key).alias(parent_key))
               .agg(F.countDistinct(child_id).alias("actual")))
    joined = parents.select(parent_key, F.col(expected).alias("expected")).join(
        counted, parent_key, "left").withColumn("actual", F.coalesce("actual", F.lit(0)))
    return joined.filter(F.col("expected").isNull() | (F.col("actual") < F.col("expected")))


def null_shares(df: DataFrame, group: str, missing: Column) -> DataFrame:
    """Per group: rows, rows with a missing value, and their share in percent."""
    return df.groupBy(group).agg(
        F.count("*").alias("total"), F.count_if(missing).alias("null_count"),
        F.round(F.lit(100.0) * F.count_if(missing) / F.count("*"), 1).alias("null_pct"))


def incomplete_round_robin(games: DataFrame, group: str, season: str, game: str, club: str,
                           members: DataFrame | None = None,
                           skip_groups: Iterable[str] = (),
                           skip_pairs: Iterable[tuple] = ()) -> DataFrame:
    """Seasons whose number of games is not n * (n - 1) for the n clubs that played.

    The newest season is still running and left out, as are groups seen in one season
    only, groups of another format, and single (group, season) exceptions. ``members``
    restricts the groups that are checked. Games are scanned once; the few counts by group and
    season are stored, since three questions are asked of them.
    """
    counts = distinct_ids(games, [group, season], {"actual_games": game, "season_clubs": club})
    per_season = write_table(counts, scratch(games.sparkSession, "seasons"))
    newest = per_season.agg(F.max(season)).scalar()
    lasting = (per_season.groupBy(group).agg(F.count(season).alias("seasons"))
               .filter("seasons > 1").select(group))
    counted = per_season.filter(F.col(season) != newest)
    if members is not None:
        counted = counted.join(members.select(group), group, "left_semi")
    skip_groups, skip_pairs = list(skip_groups), list(skip_pairs)
    if skip_groups:
        counted = counted.filter(~F.col(group).isin(*skip_groups))
    if skip_pairs:
        known = F.array(*[F.struct(F.lit(g).alias("g"), F.lit(s).alias("s"))
                          for g, s in skip_pairs])
        pair = F.struct(F.col(group).alias("g"), F.col(season).alias("s"))
        counted = counted.filter(~F.array_contains(known, pair))
    expected = F.col("season_clubs") * (F.col("season_clubs") - 1)
    return (counted.join(lasting, group, "left_semi")
            .withColumn("expected_games", expected)
            .filter(F.col("actual_games") != F.col("expected_games")))


def short_history(df: DataFrame, entity: str, value: str, minimum: int) -> DataFrame:
    """Entities that show fewer distinct values over time than expected."""
    return (df.groupBy(entity).agg(F.countDistinct(value).alias("distinct_values"))
            .filter(F.col("distinct_values") < minimum))


def short_history_of(df: DataFrame, entity: str, which, value: str, minimum: int) -> DataFrame:
    """The same for one entity, which also fails when it has no row at all."""
    return (df.filter(F.col(entity) == which)
            .agg(F.countDistinct(value).alias("distinct_values"))
            .filter(F.col("distinct_values") < minimum))


def lost_entities(source: DataFrame, usable: Column, result: DataFrame, key: str) -> DataFrame:
    """Entities with usable rows in the source that the result no longer has."""
    return source.filter(usable).select(key).distinct().join(
        result.select(key), key, "left_anti")


def cast_failures(df: DataFrame, texts: Mapping[str, Column], parsed: Mapping[str, Column]) -> DataFrame:
    """Per field: texts that are not empty and yet could not be read."""
    counts = [F.count_if(texts[c].isNotNull() & (texts[c] != "") & parsed[c].isNull()).alias(c)
              for c in texts]
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("failures"))
                               for c in texts]))
    return df.agg(*counts).select(rows.alias("r")).select("r.*")
