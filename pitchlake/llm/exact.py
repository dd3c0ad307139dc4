"""Exact deduplication with a keyed streaming state.

Documents arrive as a stream of (digest, id, locator). A streaming aggregation keeps, for
every digest ever seen, the smallest id with its locator and the number of rows; the state
lives on disk in RocksDB, is never expired and goes on where the last run ended. The locator is
the file and row where the document is stored. Rows whose digest has been seen more than once
are hits: whole normalised texts are compared, those of earlier calls as read back by their
locators, and texts that share a digest without being equal are told apart by the text itself.
Of texts that share a digest, the state locates the one with the smallest id.
All of it is built on Spark functions.

Defined results: a null text counts as empty, and empty texts are equal; a null id comes after
all others; a document is known by its id, so repeated rows of one id with equal texts are all
marked like the first and all counted; an empty table gives an empty result; only the id and
text columns are read, so other columns cannot clash. With a state, the documents of a named
batch are counted once however often the call is repeated.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.llm.common import SPACE, query, settle, table, text_of
from pitchlake.session import scratch
from pitchlake.sinks.writers import write_table

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share this much memory; the rest of the state is on disk.
    # A store would set aside some megabytes of disk for its logs, and there are many stores.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
FILES_PER_BATCH = 1_000


def normalised(column: str) -> Column:
    return F.regexp_replace(text_of(column), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


LOCATOR = "struct<file: string, row: long>"


def located(docs: DataFrame) -> Column:
    """Where a row is stored; NULL for rows that do not come straight from files."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return F.lit(None).cast(LOCATOR)
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def arrivals(docs: DataFrame, id_col: str, text_col: str,
             digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One narrow row per document: what the stream carries."""
    return docs.select(
        F.col(id_col).alias("id"), digest(normalised(text_col)).alias("digest"),
        located(docs).alias("locator"))


def absorb(spark: SparkSession, folder: str, state: str,
           files_per_batch: int = FILES_PER_BATCH) -> None:
    """Feed the files of a folder that the state has not seen yet into the state."""
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    schema = spark.read.parquet(folder).schema
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "locator"))
        (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
         .parquet(folder).groupBy("digest").agg(first.alias("first"), F.count("*").alias("n"))
         .writeStream.outputMode("update").format("noop").trigger(availableNow=True)
         .option("checkpointLocation", state).start().awaitTermination())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def seen(spark: SparkSession, state: str) -> DataFrame:
    """State as a table: digest, keep_id, locator of its content, number of rows."""
    rows = spark.read.format("statestore").load(state)
    first, n = (F.col("value")[name] for name in rows.schema["value"].dataType.names)
    return rows.select(F.col("key")["digest"].alias("digest"), first["id"].alias("keep_id"),
                       first["locator"].alias("locator"), n.alias("n"))


def stored_texts(found: DataFrame, text_col: str) -> DataFrame:
    """Digest, smallest id, number and normalised text of documents, read by their locators.

    Only the files that are named are read.
    """
    files = [unquote(r["file"]) for r in found.select("locator.file").filter(
        "file is not null").distinct().collect()]
    if not files:
        return found.select("digest", "keep_id", "n", F.lit(None).cast("string").alias("text")).limit(0)
    content = found.sparkSession.read.parquet(*files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        normalised(text_col).alias("text"))
    places = found.select("digest", "keep_id", "n", "locator.*")
    return places.join(content, ["file", "row"]).select("digest", "keep_id", "n", "text")


def unequal(docs: DataFrame, text_col: str, digest: Callable[[Column], Column] = sha256,
            earlier: DataFrame | None = None) -> DataFrame:
    """Digests that stand for more than one text, by comparing whole texts.

    Equal texts are reduced to one within each task, so a group of any size sends each of its
    texts once per task at most; what is left is one row for each digest and text.
    """
    text = normalised(text_col)
    texts = docs.select(digest(text).alias("digest"), text.alias("text"))
    if earlier is not None:
        texts = texts.union(earlier.select("digest", "text"))
    return texts.distinct().groupBy("digest").count().filter("count > 1").select("digest")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                state: str | None = None, files_per_batch: int = FILES_PER_BATCH,
                digest: Callable[[Column], Column] = sha256,
                batch: str | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, digest.

    With a ``state`` folder, documents of earlier calls count too: the first of equal texts is
    the smallest id of all calls. Their files have to be where they were, since hits on them
    are compared in full; documents that do not come from files are stored beside the state.
    """
    spark = docs.sparkSession
    if state is None:
        return _judge(docs, id_col, text_col, scratch(spark, "seen"), files_per_batch, digest,
                      "only", None)
    if not _from_files(docs):
        docs = write_table(docs.select(id_col, text_col),
                           f"{state}-content/{batch or uuid.uuid4().hex}")
    # What was known before this call; later the state knows these documents as well.
    known = settle(seen(spark, state), "known") if _started(spark, state) else None
    return _judge(docs, id_col, text_col, state, files_per_batch, digest,
                  batch or uuid.uuid4().hex, known)


def _from_files(docs: DataFrame) -> bool:
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _started(spark: SparkSession, state: str) -> bool:
    """Whether the stream behind a state has finished a batch."""
    try:
        return not spark.read.format("binaryFile").load(f"{state}/commits").select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """Arrivals below a path, if any have been written completely."""
    try:
        rows = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return None if rows.isEmpty() else rows


def _judge(docs: DataFrame, id_col: str, text_col: str, state: str, files_per_batch: int,
           digest: Callable[[Column], Column], batch: str, before: DataFrame | None) -> DataFrame:
    spark, path = docs.sparkSession, f"{state}-inbox/{batch}"
    new = _stored(spark, path)
    if new is None:
        # What an attempt that failed may have left is not complete and gives way.
        arrivals(docs, id_col, text_col, digest).write.mode("overwrite").parquet(path)
        new = spark.read.parquet(path)
    if not new.isEmpty():
        absorb(spark, f"{state}-inbox/*", state, files_per_batch)
        known = seen(spark, state)
    else:
        known = _empty_state(new)
    out = new.join(known.select("digest", "keep_id", "n"), "digest", "left")
    earlier = None
    if before is not None:
        # A repeated call finds its own documents in the state; those are compared as they are.
        hits = before.join(new.select("digest").distinct(), "digest", "left_semi").join(
            new.select("locator"), "locator", "left_anti")
        earlier = settle(stored_texts(settle(hits, "hits"), text_col), "earlier")
    bad = settle(unequal(docs, text_col, digest, earlier), "collisions")
    if not bad.isEmpty():
        out = _by_text(docs, out, bad, id_col, text_col, digest, earlier)
    return out.select(
        F.col("id").alias(id_col), "keep_id", F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def _empty_state(rows: DataFrame) -> DataFrame:
    return rows.select("digest", F.col("id").alias("keep_id"), "locator",
                       F.lit(0).cast("long").alias("n")).limit(0)


def _by_text(docs: DataFrame, out: DataFrame, bad: DataFrame, id_col: str, text_col: str,
             digest: Callable[[Column], Column], earlier: DataFrame | None) -> DataFrame:
    """Group the documents of colliding digests by their whole text instead."""
    text = normalised(text_col)
    members = docs.select(F.col(id_col).alias("id"), digest(text).alias("digest"),
                          text.alias("text")).join(bad, "digest", "left_semi")
    counted = members.withColumn("n", F.lit(1).cast("long"))
    if earlier is not None:
        counted = counted.unionByName(earlier.withColumnRenamed("keep_id", "id"))
    classes = counted.groupBy("digest", "text").agg(
        F.min(F.struct(F.col("id").isNull(), "id"))["id"].alias("keep_id"),
        F.sum("n").alias("n"))
    told = members.join(classes, ["digest", "text"]).select("id", "digest", "keep_id", "n")
    return out.join(bad, "digest", "left_anti").select("id", "digest", "keep_id", "n").union(told)


ORACLE = r"""
with t as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body
  from documents),
g as (select body, min(doc_id) as keep_id, count(*) as group_size from t group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
from t join g using (body)
"""


@query("op7_exact_dedup", ORACLE)
def op7_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(table(spark, folder, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"))
