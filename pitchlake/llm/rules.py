"""Quality rules whose thresholds adapt to language and source.

Every text is counted once. Texts that pass the base rules feed quantile sketches, one per
language, source and measure: the values of a measure, whole numbers, fall into bins of
relative width 2 ** -``BITS``, and a sketch is the number of documents in each bin. Sketches
merge by adding bins, in any order and with the same result, so each task makes its own and
sketches of sources merge into that of their language, and those into that of the corpus.

A group is judged by the fences of its own sketch: beyond the outer quartiles by ``REACH``
times their distance, which counts as at least ``LEAST_SPREAD`` of the measure, so that a group
of almost equal values does not reject itself. A group of fewer than ``LEAST_DOCS`` documents
takes the fences of its language, or else those of the corpus. Documents meet the fences of
their group by a join. All of it is built on Spark functions.

Defined results: null, empty and blank texts have no words and fail the base rules; null
languages and sources are groups like others; repeated rows count and are judged row by row;
ties with a fence pass; where no document passes the base rules there are no fences, and none
are needed; an empty table gives an empty result; texts of any length are counted whole; only
the named columns are read, so other columns cannot clash. Repeated windows are told apart by a
64-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.common import WORD, query, settle, table, text_of

# Symbols that running text seldom holds.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50

# Bits of a value that its bin keeps.
BITS = 7
LEAST_DOCS = 200
REACH = 3
# Measures in thousandths, with the least distance of their quartiles.
LEAST_SPREAD = {"word_length": 250, "symbols": 30, "dup_lines": 160, "repeats": 100}
TWO_SIDED = ("word_length",)
GROUP = ["lang", "source"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def shift(direction: str, value: Column, by: Column) -> Column:
    return F.call_function(f"shift{direction}", value, by)


def covered(places: Column, width: int) -> Column:
    """Places within runs of ``width`` that begin at any of the sorted places."""
    spans = F.transform(places, lambda p, i: F.least(
        F.lit(width), (F.coalesce(F.get(places, i + 1) - p, F.lit(width))).cast("int")))
    return F.aggregate(spans, F.lit(0), lambda a, b: a + b)


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows that are found twice or more in the list.

    Every window is one number, a hash with its place in the low bits, so that sorting brings
    equal windows together. Neighbours with one hash have their words compared; if those
    differ, which is all but impossible, the windows are sorted by their words instead.
    """
    last = F.size(words) - width

    def by_hash(bits: Column) -> Column:
        def cut(number: Column) -> Column:
            return shift("left", shift("right", number, bits), bits)

        def place(number: Column) -> Column:
            return (number - cut(number)).cast("int")

        def numbered(at: Column) -> Column:
            return cut(F.xxhash64(*[F.get(words, at + i) for i in range(width)])) + at

        def of(ordered: Column) -> Column:
            def same_hash(i: Column) -> Column:
                return (shift("right", F.get(ordered, i), bits)
                        == shift("right", F.get(ordered, i - 1), bits))

            def count(found: Column) -> Column:
                def pair(i: Column) -> Column:
                    return F.array(place(F.get(ordered, i - 1)), place(F.get(ordered, i)))

                def other_words(i: Column) -> Column:
                    one, two = (F.slice(words, place(F.get(ordered, j)) + 1, width)
                                for j in (i - 1, i))
                    return one != two

                places = F.sort_array(F.array_distinct(F.flatten(F.transform(found, pair))))
                return F.when(F.exists(found, other_words), by_words()).otherwise(
                    let(places, lambda p: covered(p, width)))

            return let(F.filter(F.sequence(F.lit(1), last), same_hash), count)

        return let(F.sort_array(F.transform(F.sequence(F.lit(0), last), numbered)), of)

    def by_words() -> Column:
        windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            F.slice(words, i + 1, width).alias("words"), i.alias("at")))

        def of(ordered: Column) -> Column:
            def twice(w: Column, i: Column) -> Column:
                return (F.coalesce(F.get(ordered, i - 1)["words"] == w["words"], F.lit(False))
                        | F.coalesce(F.get(ordered, i + 1)["words"] == w["words"], F.lit(False)))
            return F.sort_array(F.transform(F.filter(ordered, twice), lambda w: w["at"]))

        return let(let(F.sort_array(windows), of), lambda p: covered(p, width))

    bits = F.length(F.bin(F.size(words)))
    return F.when(last > 0, let(bits, by_hash)).otherwise(0)


def counts(docs: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """Kept columns and the counts of every whole text."""
    text = text_of(text_col)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"),
                        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
                        repeated_words(words).cast("long").alias("n_repeat_words"))

    def of_lines(found: Column) -> Column:
        return F.struct(F.size(found).cast("long").alias("n_lines"),
                        (F.size(found) - F.size(F.array_distinct(found))).cast("long")
                        .alias("n_dup_lines"))

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    plain = F.length(F.regexp_replace(text, SYMBOLS, ""))
    counted = docs.select(
        *keep, let(words, of_words).alias("w"), let(lines, of_lines).alias("l"),
        (F.length(text) - plain).cast("long").alias("n_symbols"))
    # The generator keeps the fields from being moved below, where each would count again.
    return counted.select(*keep, "n_symbols", F.inline(F.array(
        F.struct("w.n_words", "w.word_chars", "w.n_repeat_words", "l.n_lines", "l.n_dup_lines"))))


def base_failed() -> Column:
    return ((F.col("n_words") < LEAST_WORDS)
            | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def measures() -> dict[str, Column]:
    """Measures in thousandths; NULL where there is nothing to measure."""
    def share(part: str, whole: str) -> Column:
        whole_ = F.when(F.col(whole) > 0, F.col(whole))
        return F.floor(1000 * F.col(part) / whole_).cast("long")

    return {"word_length": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"),
            "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words")}


def bin_of(value: Column) -> Column:
    """Bin of a whole number from 0 on: its highest ``BITS`` bits and how many are cut off."""
    cut = F.greatest(F.lit(0), F.length(F.bin(value)) - BITS)
    return (cut * (1 << (BITS - 1)) + F.call_function("shiftright", value, cut)).cast("int")


def least_of(bin_: Column) -> Column:
    """Least number of a bin."""
    half = 1 << (BITS - 1)
    cut = F.greatest(F.lit(0), F.floor(bin_ / half) - 1).cast("int")
    return F.call_function("shiftleft", (bin_ - cut * half).cast("long"), cut)


def sketches(passed: DataFrame) -> DataFrame:
    """Sketch of every language, source and measure: rows ``(lang, source, measure, bin, n)``."""
    values = F.explode(F.array(*[F.struct(F.lit(name).alias("measure"), value.alias("value"))
                                 for name, value in measures().items()]))
    return (passed.select(*GROUP, values.alias("v")).filter("v.value is not null")
            .groupBy(*GROUP, F.col("v.measure").alias("measure"), bin_of(F.col("v.value")).alias("bin"))
            .agg(F.count("*").alias("n")))


def merged(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Sketches of larger groups."""
    return parts.groupBy(*group, "measure", "bin").agg(F.sum("n").alias("n"))


def quartiles(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Documents and outer quartiles of every group and measure, from its few bins."""
    whole = Window.partitionBy(*group, "measure")
    ordered = whole.orderBy("bin")
    ranked = parts.withColumn("upto", F.sum("n").over(ordered)).withColumn(
        "docs", F.sum("n").over(whole))

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("upto") >= k * F.col("docs"), F.col("bin")))

    return ranked.groupBy(*group, "measure").agg(
        F.max("docs").alias("docs"), least_of(quartile(1)).alias("q1"),
        least_of(quartile(3)).alias("q3"))


def fences(parts: DataFrame, group: Sequence[str], least_docs: int, reach: int) -> DataFrame:
    """One row per group of enough documents with its fences ``(low, high)`` by measure."""
    found = quartiles(parts, group).filter(F.col("docs") >= least_docs)
    columns = []
    for name, least in LEAST_SPREAD.items():
        reached = reach * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        pair = F.struct((F.col("q1") - reached).alias("low"), (F.col("q3") + reached).alias("high"))
        columns.append(F.max(F.when(F.col("measure") == name, pair)).alias(name))
    return found.groupBy(*group).agg(F.struct(*columns).alias("fences"))


def thresholds(parts: DataFrame, least_docs: int = LEAST_DOCS, reach: int = REACH) -> DataFrame:
    """Fences of every language and source of a stored table of sketches."""
    own = fences(parts, GROUP, least_docs, reach).withColumnRenamed("fences", "own")
    wider = fences(merged(parts, ["lang"]), ["lang"], least_docs, reach).select(
        F.col("lang").alias("__lang"), F.col("fences").alias("wider"))
    # The corpus is a single row whatever its size.
    everything = fences(merged(parts, []), [], 0, reach).first()["fences"]
    last = F.struct(*[
        F.struct(*[F.lit(everything[m] and everything[m][side]).cast("long").alias(side)
                   for side in ("low", "high")]).alias(m) for m in LEAST_SPREAD])
    groups = parts.select(*GROUP).distinct()
    own = own.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), "own")
    same = F.col("lang").eqNullSafe(F.col("__l")) & F.col("source").eqNullSafe(F.col("__s"))
    return (groups.join(own, same, "left")
            .join(wider, F.col("lang").eqNullSafe(F.col("__lang")), "left")
            .select(*GROUP, F.coalesce("own", "wider", last).alias("fences")))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", least_docs: int = LEAST_DOCS,
          reach: int = REACH) -> DataFrame:
    """One row per input row: id, counts, base_failed, kept, and the rules it fails."""
    named = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"),
                        F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    counted = settle(counts(named, ["__id", *GROUP]).withColumn("base_failed", base_failed()),
                     "counts")
    parts = settle(sketches(counted.filter("not base_failed")), "sketches")
    limits = thresholds(parts, least_docs, reach).select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"), "fences")
    same = (F.col("lang").eqNullSafe(F.col("__lang"))
            & F.col("source").eqNullSafe(F.col("__source")))
    joined = counted.join(limits, same, "left")

    def outside(name: str, value: Column) -> Column:
        beyond = value > F.col(f"fences.{name}.high")
        return beyond | (value < F.col(f"fences.{name}.low")) if name in TWO_SIDED else beyond

    failed = F.filter(F.array(*[F.when(outside(n, v), F.lit(n)) for n, v in measures().items()]),
                      lambda rule: rule.isNotNull())
    rules = F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(failed)
    return joined.withColumn("failed", rules).select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "n_lines", "base_failed", (F.size("failed") == 0).alias("kept"), "failed")


HALF = 1 << (BITS - 1)
_SPREADS = ", ".join(f"('{name}', {least})" for name, least in LEAST_SPREAD.items())
ORACLE = rf"""
with w as (
  select *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as ls,
         row_number() over () as rid
  from documents),
g as (select rid, unnest(range(1, len(ws) - 1)) as i from w),
gr as (select g.rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram
       from g join w using (rid)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, gram) as c from gr)
          where c > 1),
cover as (select rid, count(distinct i + k) as n from twice, (values (0), (1), (2)) as t(k)
          group by rid),
c as (
  select rid, doc_id, lang, source, len(ws)::bigint as n_words,
         length(array_to_string(ws, ''))::bigint as word_chars,
         (length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))::bigint
             as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         coalesce(cover.n, 0)::bigint as n_repeat_words, len(ls)::bigint as n_lines
  from w left join cover using (rid)),
b as (select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words
          as base_failed from c),
m as (
  select rid, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) as measure,
         unnest([1000 * word_chars // nullif(n_words, 0), 1000 * n_symbols // nullif(n_words, 0),
                 1000 * n_dup_lines // nullif(n_lines, 0),
                 1000 * n_repeat_words // nullif(n_words, 0)]) as value
  from b),
s as (
  select 3 as level, lang, source, measure, value from m where not base_failed and value is not null
  union all
  select 2, lang, null, measure, value from m where not base_failed and value is not null
  union all
  select 1, null, null, measure, value from m where not base_failed and value is not null),
binned as (
  select level, lang, source, measure,
         greatest(0, length(bin(value)) - {BITS}) * {HALF}
             + (value >> greatest(0, length(bin(value)) - {BITS})::bigint) as bin, count(*) as n
  from s group by all),
ranked as (
  select *, sum(n) over (partition by level, lang, source, measure order by bin) as upto,
         sum(n) over (partition by level, lang, source, measure) as docs
  from binned),
q as (
  select level, lang, source, measure, max(docs) as docs,
         min(bin) filter (where 4 * upto >= docs) as b1, min(bin) filter (where 4 * upto >= 3 * docs) as b3
  from ranked group by all),
v as (
  select *, (b1 - greatest(0, b1 // {HALF} - 1) * {HALF})::bigint << greatest(0, b1 // {HALF} - 1)::bigint as q1,
         (b3 - greatest(0, b3 // {HALF} - 1) * {HALF})::bigint << greatest(0, b3 // {HALF} - 1)::bigint as q3
  from q where docs >= {LEAST_DOCS} or level = 1),
f as (
  select level, lang, source, measure, q1 - {REACH} * greatest(q3 - q1, least_spread) as low,
         q3 + {REACH} * greatest(q3 - q1, least_spread) as high
  from v join (values {_SPREADS}) as t(measure, least_spread) using (measure)),
pick as (
  select lang, source, measure, max(level) as level from (
      select d.lang, d.source, f.measure, f.level
      from (select distinct lang, source from m where not base_failed) d join f
        on f.level = 1 or (f.level = 2 and f.lang is not distinct from d.lang)
        or (f.level = 3 and f.lang is not distinct from d.lang
            and f.source is not distinct from d.source))
  group by all),
out as (
  select m.rid
  from m join pick p on p.lang is not distinct from m.lang and p.source is not distinct from m.source
                    and p.measure = m.measure
  join f on f.level = p.level and f.measure = p.measure
        and (f.level = 1 or f.lang is not distinct from m.lang)
        and (f.level < 3 or f.source is not distinct from m.source)
  where m.value > f.high or (m.measure = 'word_length' and m.value < f.low))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and rid not in (select rid from out) as kept
from b
"""


@query("op11_quality_rules", ORACLE)
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")
