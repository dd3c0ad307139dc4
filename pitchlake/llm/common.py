"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.session import prepare, scratch

# White space of all contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch. Texts can be long, so a batch of the default 10,000 rows could
# outgrow a worker.
BATCH_ROWS = "512"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    bundle = Path(tempfile.mkdtemp(prefix="pitchlake-code-")) / "pitchlake.zip"
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted(PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(bundle))
    _shipped.add(application)


def session(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the corpus operators rely on."""
    prepare(spark)
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register a function of (spark, folder) under a name."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def call(spark: SparkSession, folder: str) -> DataFrame:
            return build(session(spark), folder)

        QUERIES[name] = call
        if oracle is not None:
            ORACLES[name] = oracle
        return build
    return register


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: short lineage, one evaluation.

    A lost executor costs the tasks that read the table again, not the work behind it.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted(rows: DataFrame, key: Column, most: int) -> DataFrame:
    """Rows of a stored table with ``__row``, their stored position, and ``__salt``.

    The salt is 0 unless more than ``most`` rows share a key; those are spread over as many
    salts as keep ``most`` rows together, null keys included.
    """
    hashed = F.xxhash64(F.coalesce(key.cast("string"), F.lit("")))
    placed = rows.withColumn("__row", F.monotonically_increasing_id())
    hot = (rows.groupBy(hashed.alias("__hash")).count().filter(F.col("count") > most)
           .select("__hash", F.ceil(F.col("count") / most).alias("__parts")))
    return (placed.withColumn("__hash", hashed).join(hot, "__hash", "left")
            .withColumn("__salt", F.coalesce(F.col("__row") % F.col("__parts"), F.lit(0)))
            .drop("__hash", "__parts"))


def text_of(column: str) -> Column:
    """Text with null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def held_out(column: str, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; a null id counts as empty text."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % folds == 0
