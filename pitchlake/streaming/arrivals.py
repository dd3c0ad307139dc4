"""Snapshot files merged into a stored set of records as they arrive.

A file stream sees every new file once. Each batch is merged into the records of its asset: of
one record in one season the newest file counts, a later batch before an earlier one. Merged
records are a version of a release, and its commit carries the name of the stream and the
number of the batch, so a batch that is replayed changes nothing and readers see whole batches
only. Records stay lines of text with their season and file, the form that all base tables are
built from, so fields may change their type from file to file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.operators.snapshot import latest
from pitchlake.sinks.releases import Releases
from pitchlake.sources.snapshots import season_of

SCHEMA = "value string, season int, filename string"
FILES_PER_BATCH = 100

# Fields that tell the records of an asset apart within a season; others go by their link.
KEYS = {
    "appearances": ("$.parent.href", "$.competition_code", "$.matchday", "$.date"),
    "game_lineups": ("$.game_id",),
    "market_values": ("$.player_id",),
    "transfers": ("$.player_id",),
    "countries": ("$.country_id",),
}


def record_parts(asset: str) -> list[Column]:
    return [F.get_json_object("value", path) for path in KEYS.get(asset, ("$.href",))]


def merge_lines(new: DataFrame, old: DataFrame | None, parts: Sequence[Column]) -> DataFrame:
    """Records of both sides, one per season and key.

    New records go before old ones, then the greatest file and line count. Lines without any
    key stand for themselves.
    """
    rows = new.select(*_names(), F.lit(1).alias("__new"))
    if old is not None:
        rows = rows.union(old.select(*_names(), F.lit(0)))
    key = F.to_json(F.array(*parts))
    missing = F.coalesce(*parts).isNull()
    rows = rows.withColumns({
        "__key": F.when(~missing, key), "__alone": F.when(missing, F.xxhash64("value"))})
    return latest(rows, ["season", "__key", "__alone"], F.desc("__new"), F.desc("filename"),
                  F.desc("value")).select(*_names())


def _names() -> list[str]:
    return [part.split()[0] for part in SCHEMA.split(", ")]


def stored_lines(spark: SparkSession, root: str, asset: str) -> DataFrame:
    """All records of an asset that have been merged so far, as input of its base table."""
    path = Releases(spark, root).current().get(asset)
    if path is None:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def follow(spark: SparkSession, paths: str, asset: str, root: str, checkpoint: str,
           stream: str = "arrivals", files_per_batch: int = FILES_PER_BATCH) -> int:
    """Merge all files that have arrived since the last call; returns the last commit's number.

    ``stream`` names the checkpoint: another checkpoint needs another name.
    """
    releases = Releases(spark, root)
    parts = record_parts(asset)

    def merge(batch: DataFrame, number: int) -> None:
        tag = f"{stream} {asset} {number}"
        if releases.has(tag):
            return
        known = releases.current().get(asset)
        old = spark.read.schema(SCHEMA).parquet(known) if known else None
        path = releases.stage(asset, merge_lines(batch, old, parts).write.parquet)
        releases.commit({asset: path}, tag)

    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(paths)
    rows = lines.select("value", F.col("_metadata.file_path").alias("filename"))
    rows = rows.filter(F.length(F.trim("value")) > 0).select(
        "value", season_of(F.col("filename")).alias("season"), "filename")
    query = (rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return releases.number()
