"""Importance resampling towards a target distribution, with feature counts by segment.

Features are hashed n-grams of words. A newline is in no word, so it cuts a text into lines
whose features do not depend on what stands around them: equal lines of all documents are
grouped, each distinct line is counted once, and its counts are multiplied by its occurrences.
N-grams that reach over the end of a line are counted for each document and added. The gain of
a bucket compares its share in the target with its share in the corpus; the weight of a
document adds up the gains of its lines, each found once, and of its n-grams across lines.
Weights with Gumbel noise from a hash of the id give the draw: the highest scores.

Lines of documents meet the counts of distinct lines by a 128-bit hash; lines on very many
documents are reduced within each task before they are grouped, and a join with them is split
by adaptive execution. Ranks come from ranges of the sorted scores, no task holds all.

Defined results: null, empty and blank texts have no features and weight 0; a null id counts as
empty text in the noise and comes last among equal scores; repeated rows are drawn row by row,
and equal scores of equal ids in the order in which rows were stored; an empty corpus gives an
empty result, an empty target makes all counts of the target 0; texts and lines of any length
are counted whole; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.common import query, settle, table, text_of

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
# Word characters of UTF-8 once A-Z are lower case, and of texts before.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
HAS_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
# Words whose bucket a worker remembers; results do not depend on it.
REMEMBERED = 200_000


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode().lower())


class Buckets:
    """Bucket of a feature, remembered for the frequent ones."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def of(self, feature: bytes) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature) % self.buckets
        return found

    def within(self, words: list[bytes], longest: int) -> list[int]:
        """Buckets of all runs of 1 to ``longest`` words."""
        out = [self.of(w) for w in words]
        for n in range(2, longest + 1):
            out += [self.of(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
        return out

    def across(self, text: str, longest: int) -> list[int]:
        """Buckets of the runs that reach over the end of a line."""
        out, before = [], []
        for line in text.split("\n"):
            words = words_of(line)
            for end in range(min(len(words), longest - 1)):
                # Runs that end at this word and start in a line before.
                for n in range(end + 2, min(longest, end + 1 + len(before)) + 1):
                    out.append(self.of(b" ".join(before[end + 1 - n:] + words[:end + 1])))
            before = (before + words)[-(longest - 1):] if longest > 1 else []
        return out


def line_key() -> tuple[Column, Column]:
    line = F.col("line")
    return F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")


def lines_of(texts: DataFrame) -> DataFrame:
    """All lines with a word of a table with a column ``text``."""
    return texts.select(F.explode(F.split(text_of("text"), "\n")).alias("line")).filter(
        F.col("line").rlike(HAS_WORD))


def segments(corpus: DataFrame, target: DataFrame, buckets: int, longest: int) -> DataFrame:
    """Distinct lines: key, occurrences in corpus and target, words, bucket of every feature."""
    both = lines_of(corpus).select("line", F.lit(1).alias("here"), F.lit(0).alias("there")).union(
        lines_of(target).select("line", F.lit(0), F.lit(1)))
    distinct = both.groupBy("line").agg(F.sum("here").alias("here"), F.sum("there").alias("there"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = Buckets(buckets)
        for frame in frames:
            words = [words_of(line) for line in frame["line"]]
            yield frame.drop(columns="line").assign(
                words=[len(w) for w in words],
                features=[memory.within(w, longest) for w in words])

    schema = "a long, b long, here long, there long, words long, features array<int>"
    return distinct.select(*line_key(), "here", "there", "line").mapInPandas(count, schema)


def spans(texts: DataFrame, buckets: int, longest: int) -> DataFrame:
    """Column ``across`` in place of the text: buckets of features across lines."""
    if longest < 2:
        return texts.withColumn("across", F.array().cast("array<int>")).drop("text")

    @F.pandas_udf("array<int>")
    def across(column: pd.Series) -> pd.Series:
        memory = Buckets(buckets)
        return pd.Series([memory.across(t, longest) for t in column], dtype=object)

    return texts.withColumn("across", across(text_of("text"))).drop("text")


def totals(lines: DataFrame, documents: DataFrame, targets: DataFrame,
           buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Features per bucket of corpus and target: two numbers for each of the fixed buckets."""
    zero = F.lit(0).cast("long")
    rows = lines.select(F.explode("features").alias("bucket"), "here", "there").union(
        documents.select(F.explode("across"), F.lit(1).cast("long"), zero)).union(
        targets.select(F.explode("across"), zero, F.lit(1).cast("long")))
    found = rows.groupBy("bucket").agg(F.sum("here"), F.sum("there")).collect()
    corpus, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for bucket, here, there in found:
        corpus[bucket], target[bucket] = here, there
    return corpus, target


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a feature of each bucket adds to a weight, in thousandths, rounded down."""
    here, there, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (here + buckets)
                                   / ((float(s) + 1) * (there + buckets))))
        for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(id_col: str, seed: int) -> Column:
    """Gumbel noise of an id in thousandths, rounded down."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / float(1 << 32)))).cast("long")


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          target_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """Columns row, id, n_words, n_features, weight of one row per document."""
    spark = docs.sparkSession
    aim = target.select(F.col(target_col).alias("text"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    lines = settle(segments(texts, aim, buckets, longest), "segments")

    marked = texts.withColumn("row", F.monotonically_increasing_id())
    worded = F.filter(F.split(text_of("text"), "\n"), lambda line: line.rlike(HAS_WORD))
    keys = F.transform(worded, lambda line: F.struct(
        F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b")))
    documents = settle(spans(marked.withColumn("lines", keys), buckets, longest), "documents")
    targets = spans(aim, buckets, longest)
    # As many numbers as there are buckets.
    gain = spark.sparkContext.broadcast(gains(*totals(lines, documents, targets, buckets)))

    @F.pandas_udf("long")
    def gained(features: pd.Series) -> pd.Series:
        return pd.Series([int(gain.value[f].sum()) for f in features], dtype="int64")

    weighed = lines.select("a", "b", "words", F.size("features").alias("features"),
                           gained("features").alias("gain"))
    of_lines = (documents.select("row", F.inline("lines")).join(weighed, ["a", "b"])
                .groupBy("row").agg(F.sum("words").alias("words"),
                                    F.sum("features").alias("features"), F.sum("gain").alias("gain")))
    beyond = gained("across") if longest > 1 else F.lit(0).cast("long")
    whole = documents.select("row", "id", F.size("across").alias("extra"), beyond.alias("beyond"))
    zero = F.lit(0).cast("long")
    return whole.join(of_lines, "row", "left").select(
        "row", "id", F.coalesce("words", zero).alias("n_words"),
        (F.coalesce("features", zero) + F.col("extra")).alias("n_features"),
        (F.coalesce("gain", zero) + F.col("beyond")).alias("weight"))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Rows with ``rank`` from 1 on, in a total order.

    Rows are sorted in ranges; a range starts where the ones before it end.
    """
    pieces = settle(rows.repartitionByRange(*order).withColumn(
        "__piece", F.spark_partition_id()), "ranges")
    # One number per range.
    before = Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (pieces.groupBy("__piece").count()
              .withColumn("__start", F.coalesce(F.sum("count").over(before), F.lit(0)))
              .drop("count"))
    within = Window.partitionBy("__piece").orderBy(*order)
    return (pieces.join(starts, "__piece")
            .withColumn("rank", F.col("__start") + F.row_number().over(within))
            .drop("__piece", "__start"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST,
             least_words: int = LEAST_WORDS, percent: int = PERCENT,
             seed: int = SEED) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank (NULL if it is not drawn)."""
    weights = weigh(docs, target, id_col, text_col, target_col, buckets, longest)
    scored = settle(weights.withColumn("score", F.col("weight") + noise("id", seed)), "scores")
    open_ = scored.filter(F.col("n_words") >= least_words).select("row", "id", "score")
    drawn = percent * open_.count() // 100
    ranks = ranked(open_, F.desc("score"), F.asc_nulls_last("id"), F.asc("row")).filter(
        F.col("rank") <= drawn).select("row", "rank")
    return scored.join(ranks, "row", "left").select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank")


# crc32 of a word: a table of 256 numbers, then a fold over the bytes of its hexadecimal form.
ORACLE = rf"""
with bits as (
  select i, list_reduce(list_prepend(i::bigint, [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda c, z: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end) as v
  from range(256) r(i)),
tab as (select list(v order by i) as t from bits),
d as (select row_number() over () as rid, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
      from documents),
b as (select regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
      from benchmark),
dw as (select rid, unnest(ws) as w from d),
bw as (select unnest(ws) as w from b),
vocabulary as (select w, hex(encode(w)) as h from (select w from dw union select w from bw)),
coded as (
  select w, xor(4294967295, list_reduce(
      list_prepend(4294967295::bigint,
          list_transform(range(len(h) // 2), lambda k: ('0x' || substr(h, 2 * k + 1, 2))::bigint)),
      lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) % {BUCKETS} as bucket
  from vocabulary, tab),
s as (select bucket, count(*) as s from dw join coded using (w) group by 1),
t as (select bucket, count(*) as t from bw join coded using (w) group by 1),
sums as (select (select coalesce(sum(s), 0) from s)::double as ss, (select coalesce(sum(t), 0) from t)::double as tt),
gain as (
  select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * (ss + {BUCKETS})
                                 / ((coalesce(s, 0)::double + 1) * (tt + {BUCKETS}))))::bigint as gain
  from s full join t using (bucket), sums),
weight as (select rid, sum(gain)::bigint as weight from dw join coded using (w) join gain using (bucket) group by 1),
scored as (
  select rid, doc_id, len(ws)::bigint as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln(
             (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint
             as score
  from d left join weight using (rid)),
ranked as (
  select rid, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
  from scored where n_features >= {LEAST_WORDS})
select doc_id, n_features, weight, score, rank
from scored left join (select rid, rank from ranked where rank <= {PERCENT} * n // 100) using (rid)
"""


@query("op13_importance_resampling", ORACLE)
def op13_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
