"""Raw snapshots: one JSON object per line, one folder per season."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pitchlake.sources import records

# What the CSV reader takes for NULL besides absent fields; no exported text holds it.
NO_TEXT = "\0"


def expand_seasons(text: str, most: int | None = None) -> list[int]:
    """``2012-2014`` as a list of seasons, a single year as a list of one.

    With ``most``, longer ranges are refused.
    """
    bounds = [int(part) for part in text.split("-")]
    if len(bounds) > 2:
        raise ValueError(f"not a season or a range of seasons: {text}")
    seasons = list(range(bounds[0], bounds[-1] + 1))
    if most is not None and len(seasons) > most:
        raise ValueError(f"{text} covers more than {most} seasons")
    return seasons


def season_of(path: Column) -> Column:
    """The folder that holds the file names the season, ``2024`` or ``season=2024``.

    A file that Spark has written is a folder of parts, maybe with a folder per version.
    """
    folder = r"/(?:[^/]*=)?([0-9]+)/[^/]+(?:(?<=\.json|\.gz)(?:/version-[0-9a-f]+)?/[^/]+)?$"
    return F.regexp_extract(path, folder, 1).try_cast("int")


def file_name(path: Column) -> Column:
    return F.try_element_at(F.split(path, "/"), F.lit(-1))


def season_paths(root: str, file: str, seasons: Iterable[int] | None = None,
                 folder: str = "{}") -> list[str]:
    """Reader paths of one asset; naming the seasons keeps other folders from being listed."""
    if seasons is None:
        return [f"{root}/*/{file}"]
    return [f"{root}/{folder.format(season)}/{file}" for season in seasons]


def read_snapshots(spark: SparkSession, paths: str | list[str],
                   spread: int | None = None) -> DataFrame:
    """Rows ``(value, season, filename)``; gzip is told by extension.

    A gzip file is one task however large it is. ``spread`` redistributes its lines over
    that many tasks before they are parsed.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("filename"))
    rows = lines.filter(F.length(F.trim("value")) > 0).select(
        "value", season_of(F.col("filename")).alias("season"), "filename")
    return rows.repartition(spread) if spread else rows


def read_records(spark: SparkSession, paths: str | list[str], schema=None,
                 text: Iterable[str] = (), as_json: Iterable[str] = ()) -> DataFrame:
    """Typed JSON records, with the united type of all lines unless a schema is given.

    Columns whose type drifts between files are forced to text (``text``) or to JSON text
    (``as_json``), so files of different age can be united by name. Lines that cannot be read
    are an error.
    """
    if schema is not None:
        return force_types(spark.read.schema(schema).json(paths), text, as_json)
    rows = records.read_variants(spark, paths)
    lost = records.unreadable(rows).count()
    if lost:
        raise ValueError(f"{lost} lines are no JSON objects in {paths}")
    return records.unite([rows], {*text, *as_json})[0]


def force_types(df: DataFrame, text: Iterable[str] = (), as_json: Iterable[str] = ()) -> DataFrame:
    types = dict(df.dtypes)
    forced = {c: F.col(c).cast("string") for c in text if c in types}
    for c in as_json:
        if c in types:
            nested = types[c].startswith(("struct", "array", "map"))
            forced[c] = F.to_json(c) if nested else F.col(c).cast("string")
    return df.withColumns(forced)


def read_seasons(spark: SparkSession, root: str, file: str, seasons: Iterable[int],
                 schema, folder: str = "{}") -> DataFrame:
    """All seasons of one asset as typed records with ``season`` and ``season_file``."""
    records = spark.read.schema(schema).json(season_paths(root, file, seasons, folder))
    path = F.col("_metadata.file_path")
    return records.select("*", season_of(path).alias("season"), path.alias("season_file"))


def read_table_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A published table; types are inferred when no schema is given.

    A field without quotes and without text is NULL, ``""`` is empty text, and line breaks
    within quotes belong to the field. A file is one task, as gzip files are in any case.
    """
    reader = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
              .option("nullValue", NO_TEXT).option("emptyValue", ""))
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)
