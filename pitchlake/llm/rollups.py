"""Token counts as rollups that are maintained by signed deltas.

A change sets the count of a document under a tokenizer version, or deletes it. A commit looks
up what the ledger holds for the changed keys, and turns every change into a signed delta: the
old count leaves the totals of its source, language and version, the new one enters. Ledger
rows and deltas of a batch are written beside each other below the number of the batch, and a
commit record makes them visible. A batch whose id has been committed is not applied again,
and what a failed attempt has written is overwritten by the next, so a batch counts once.

Defined results: a null count is a delete, and deleting what is not there changes nothing; the
change with the highest sequence number of a key wins within a batch, of equal ones the
largest row; null ids, sources and languages are values like others; totals of no documents
are left out; an empty batch is committed and changes nothing; only the named columns are
read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, settle, table, text_of
from pitchlake.session import scratch

KEY = ["doc_id", "version"]
VALUE = ["source", "lang", "tokens"]
TOTAL = ["source", "lang", "version"]
LEDGER = "doc_id long, version string, source string, lang string, tokens long, batch long"
DELTAS = "source string, lang string, version string, docs long, tokens long, batch long"
COMMITS = "batch long, name string"


class Rollup:
    """Totals below a folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, part: str, schema: str) -> DataFrame:
        """Rows of a part; a part that nothing has been written to has none."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{part}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def batches(self) -> dict[str, int]:
        """Names of committed batches and their numbers: one row per commit."""
        return {r["name"]: r["batch"] for r in self._read("commits", COMMITS).collect()}

    def _committed(self, part: str, schema: str, upto: int) -> DataFrame:
        return self._read(part, schema).filter(F.col("batch") < upto)

    def commit(self, name: str, changes: DataFrame) -> bool:
        """Apply a batch with columns doc_id, version, source, lang, tokens, seq.

        Returns whether it was new. One writer at a time.
        """
        known = self.batches()
        if name in known:
            return False
        number = max(known.values(), default=-1) + 1
        last = changes.groupBy(*KEY).agg(
            F.max_by(F.struct(*VALUE), F.struct("seq", *VALUE)).alias("new"))
        last = settle(last, "changes")
        keys = last.select(*[F.col(k).alias(f"__{k}") for k in KEY])
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEY]
        held = self._committed("ledger", LEDGER, number).join(keys, same, "left_semi")
        held = held.groupBy(*[F.col(k).alias(f"__{k}") for k in KEY]).agg(
            F.max_by(F.struct(*VALUE), "batch").alias("old"))
        both = last.join(held, same, "left")
        sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("v")),
                        F.struct(F.lit(1).alias("sign"), F.col("new").alias("v")))
        signed = both.select("version", F.explode(sides).alias("s")).select(
            "version", "s.sign", "s.v.*").filter(F.col("tokens").isNotNull())
        deltas = signed.groupBy(*TOTAL).agg(
            F.sum("sign").alias("docs"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens"))
        self._write("ledger", LEDGER, number, last.select(*KEY, "new.*"))
        self._write("deltas", DELTAS, number, deltas)
        record = self.spark.range(1).select(F.lit(name).alias("name"))
        self._write("commits", COMMITS, number, record)
        return True

    def _write(self, part: str, schema: str, number: int, rows: DataFrame) -> None:
        rows = rows.withColumn("batch", F.lit(number)).select(
            *[F.col(name).cast(kind) for name, kind in map(str.split, schema.split(", "))])
        rows.write.mode("overwrite").parquet(f"{self.folder}/{part}/{number:012d}")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        upto = max(self.batches().values(), default=-1) + 1
        return (self._committed("deltas", DELTAS, upto).groupBy(*TOTAL)
                .agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs <> 0 or tokens <> 0"))


WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"
RUNS = r"[A-Za-z0-9]+"


def counted(docs: DataFrame, version: str, pattern: str, seq: int = 0) -> DataFrame:
    """Changes that set the count of every document under a tokenizer given by a pattern."""
    return docs.select("doc_id", F.lit(version).alias("version"), "source", "lang",
                       F.regexp_count(text_of("text"), F.lit(pattern)).cast("long")
                       .alias("tokens"), F.lit(seq).alias("seq"))


def repeats(docs: DataFrame) -> DataFrame:
    """Documents whose text another one of a smaller id has."""
    same: Column = F.sha2(text_of("text"), 256)
    named = docs.select("doc_id", "source", "lang", same.alias("same"))
    first = named.groupBy("same").agg(F.min("doc_id").alias("first"))
    return named.join(first, "same").filter("doc_id <> first").select("doc_id", "source", "lang")


ORACLE = r"""
with d as (
  select *, coalesce(text, '') as body,
         min(doc_id) over (partition by coalesce(text, '')) as first
  from documents),
k as (select * from d where doc_id = first),
c as (
  select source, lang, 'words' as version,
         len(regexp_extract_all(body, '[A-Za-z0-9]+')) as n from k
  union all
  select source, lang, 'pieces',
         len(regexp_extract_all(body, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) from k)
select source, lang, version, count(*) as docs, sum(n)::bigint as tokens
from c group by all
"""


@query("op6_token_rollup", ORACLE)
def op6_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Insert all counts, delete repeated texts, revise one version, replay a batch."""
    docs = table(spark, folder, "documents")
    rollup = Rollup(spark, scratch(spark, "rollup"))
    inserts = counted(docs, "words", WORDS).union(counted(docs, "pieces", PIECES))
    rollup.commit("inserts", inserts)
    gone = settle(repeats(docs), "repeats")
    versions = F.explode(F.array(F.lit("words"), F.lit("pieces")))
    rollup.commit("deletes", gone.select(
        "doc_id", versions.alias("version"), "source", "lang",
        F.lit(None).cast("long").alias("tokens"), F.lit(0).alias("seq")))
    revised = counted(docs, "words", RUNS).join(gone.select("doc_id"), "doc_id", "left_anti")
    rollup.commit("revisions", revised)
    rollup.commit("inserts", inserts)
    return rollup.totals()
