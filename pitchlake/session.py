"""Session defaults and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Adaptive execution splits hot join partitions and sizes shuffles at run time.
# The force flag keeps the split even where it costs the output partitioning.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "pitchlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the operators rely on to a given session."""
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


HASH_JOIN_LIMIT = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


@contextmanager
def hash_joins(spark: SparkSession) -> Iterator[None]:
    """Shuffled joins go by hash, without sorting either side, where one side allows it.

    Adaptive execution decides so from measured sizes: every partition of that side must stay
    below the size that partitions are merged up to, others are sorted as before.
    """
    before = spark.conf.get(HASH_JOIN_LIMIT)
    spark.conf.set(HASH_JOIN_LIMIT, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.set(HASH_JOIN_LIMIT, before)


def shared_root(spark: SparkSession) -> str:
    """Folder all executors reach, as named by the cluster.

    Only a session in a single process without ``spark.checkpoint.dir`` (unit tests) gets a
    local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix="pitchlake-")


def scratch(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_root(spark)}/pitchlake/{label}-{uuid.uuid4().hex}"
