"""From raw documents to token counts of a mixed, deduplicated corpus.

Every stage reads a stored table (Parquet) and returns rows of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.llm.bpe import byte_bpe, digests
from pitchlake.llm.common import session, settle, table
from pitchlake.llm.exact import deduplicate
from pitchlake.llm.mixing import mix
from pitchlake.llm.simhash import near_duplicates
from pitchlake.llm.toxicity import scorer, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    session(spark)
    score = scorer(spark, train(docs, table(spark, sf_dir, "labels")))
    return docs.filter(score(F.col("text")) < 0.5)


def _placed(docs: DataFrame) -> DataFrame:
    """Rows of a stored table with ``__file`` and ``__at``, where each is stored.

    Ids may repeat or be null; a stage decides about rows and finds them by their place.
    """
    return docs.select("*", F.col("_metadata.file_path").alias("__file"),
                       F.col("_metadata.row_index").alias("__at"))


def _ranked(docs: DataFrame) -> DataFrame:
    """Text and ``__key`` of every row: ordered by id, null last, and different for all rows.

    Rows of one id are ordered by their content, and equal rows by their place.
    """
    key = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id",
                   F.xxhash64(*docs.columns).alias("content"), "__file", "__at")
    return _placed(docs).select(key.alias("__key"), "text")


def _keep(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is listed.

    Both sides are shuffled at every size: what is listed grows with the documents.
    """
    kept = settle(keys.select("__key.__file", "__key.__at"), "kept")
    return _placed(docs).join(kept.hint("merge"), ["__file", "__at"], "left_semi").select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id."""
    session(spark)
    return _keep(docs, deduplicate(_ranked(docs), id_col="__key").filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash, the row with the smallest id."""
    session(spark)
    groups = near_duplicates(_ranked(docs), id_col="__key", width=3, radius=3)
    return _keep(docs, groups.filter("__key = component_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it."""
    session(spark)
    plan = mix(_placed(docs), carry=["__file", "__at"]).filter("copies > 0")
    copies = plan.select("__file", "__at", F.col("copies").alias("__copies"))
    taken = _placed(docs).join(copies.hint("merge"), ["__file", "__at"])
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(
        docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the ids of every document, and digest of the decoded text."""
    session(spark)
    return digests(docs, byte_bpe())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

# Classifier, fingerprints, random rounding and byte-pair merges have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the stored result of the one before."""
    docs = table(session(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
