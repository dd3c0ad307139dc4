"""Document fingerprints as threshold-scaled sketches.

A sketch holds every hash of a shingle below a fixed fraction of the hash range, so its size
follows the document, sketches merge by union, and the share of a sketch that lies in another
estimates containment even between very unequal documents. Shingles are runs of ``WIDTH``
characters, about five words: a short text has dozens of them where it would have a handful of
word shingles, so a fraction of 1 / ``FRACTION`` leaves it something to be compared by, and a
sketch is still shorter than its text.

A text with shingles but no hash below the limit keeps its least hash; that rule merges too,
since the least hash of a union is the least of both. Whether a sketch with hashes below the
limit contains such a text cannot be told: containment is then NaN, and likeness 0.

``beside`` walks documents in the order of their ids and gives each one its successor: ids are
cut into ranges, a range also gets the first document of the next one, and each task streams
through its sorted ranges holding one document at a time.

Defined results: null counts as empty; an empty text has an empty sketch, which is like another
empty one (1) and unlike all others (0); a text shorter than a shingle is one shingle;
null ids come first, repeated ids are ordered by text; a single document is its own successor;
an empty table gives an empty result; only the id and text columns are read, so other columns
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, table, text_of

WIDTH = 24
FRACTION = 16
HASH_BITS = 40
LIMIT = (1 << HASH_BITS) // FRACTION - 1
DIGITS = HASH_BITS // 4
LEAST_ID = -(1 << 63)
# Characters hashed at once; longer texts are hashed in overlapping pieces.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15


def _power(n: int) -> np.uint64:
    return np.uint64(pow(BASE, n, 1 << 64))


def rolled(points: np.ndarray, width: int) -> np.ndarray:
    """Polynomial of every run of ``width`` code points, from those of half the width."""
    if width == 1:
        return points
    half = width // 2
    low = rolled(points, half)
    out = low[:len(points) - 2 * half + 1] * _power(half) + low[half:]
    return out if width % 2 == 0 else out[:-1] * _power(1) + points[width - 1:]


def mixed(values: np.ndarray) -> np.ndarray:
    """Even hashes of ``HASH_BITS`` bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(31))) >> np.uint64(64 - HASH_BITS)


def sketch(text: str, width: int = WIDTH, limit: int = LIMIT) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles up to the limit, or the least one."""
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
    width = min(width, len(points))
    parts, least = [], None
    for start in range(0, len(points) - width + 1, PIECE):
        hashes = mixed(rolled(points[start:start + PIECE + width - 1], width))
        parts.append(hashes[hashes <= np.uint64(limit)])
        least = hashes.min() if least is None else min(least, hashes.min())
    below = np.unique(np.concatenate(parts))
    return below if below.size else np.array([least])


def _kept(hashes: np.ndarray, limit: int) -> np.ndarray:
    below = hashes[hashes <= np.uint64(limit)]
    return np.unique(below) if below.size else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Sketch of both texts' shingles together."""
    both = np.union1d(a, b)
    return _kept(both, limit) if both.size else both


def containment(a: np.ndarray, b: np.ndarray, limit: int = LIMIT) -> float:
    """Estimated share of the shingles of a that b has too; NaN if b cannot hold those of a."""
    if not a.size or not b.size:
        return float(a.size == b.size)
    if a.min() > np.uint64(limit) >= b.min():
        return float("nan")
    return np.intersect1d(a, b, assume_unique=True).size / a.size


def likeness(a: np.ndarray, b: np.ndarray, limit: int = LIMIT) -> float:
    """Containment of the smaller sketch in the larger, 0 where it cannot be told."""
    found = containment(a, b, limit) if a.size <= b.size else containment(b, a, limit)
    return 0.0 if np.isnan(found) else found


def written(hashes: np.ndarray) -> str:
    """Hashes as hexadecimal digits, a fixed number for each."""
    wide = hashes.astype(">u8").tobytes().hex()
    return "".join(wide[i + 16 - DIGITS:i + 16] for i in range(0, len(wide), 16))


def parsed(fingerprint: str) -> np.ndarray:
    return np.array([int(fingerprint[i:i + DIGITS], 16) for i in range(0, len(fingerprint), DIGITS)],
                    np.uint64)


def beside(docs: DataFrame, visit: Callable, schema: str, id_col: str, text_col: str,
           prepare: Callable[[str], object]) -> DataFrame:
    """Rows ``visit(id, text, prepared, next_text, next_prepared)`` of all documents.

    Documents follow each other by ascending id, the first follows the last. ``prepare`` is
    called once per document and range. Ids are whole numbers.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    position = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID))
    places = docs.select(position.alias("pos"))
    cuts = places.agg(F.percentile_approx(
        "pos", [i / ranges for i in range(1, ranges)] or [0.5], 20 * ranges)).first()[0]
    # One number per range on the driver, however many documents there are.
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def range_of(pos: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, pos.to_numpy(), side="right").astype(np.int32))

    firsts = sorted(tuple(r) for r in places.groupBy(range_of("pos").alias("range")).agg(
        F.min("pos")).collect())
    first_of = {pos: firsts[i - 1][0] for i, (_, pos) in enumerate(firsts)}

    @F.pandas_udf("array<struct<range int, tail boolean>>")
    def dealt(pos: pd.Series) -> pd.Series:
        at = np.searchsorted(cuts, pos.to_numpy(), side="right").tolist()
        out = []
        for p, own in zip(pos.tolist(), at):
            rows = [{"range": own, "tail": False}]
            if p in first_of:
                rows.append({"range": first_of[p], "tail": True})
            out.append(rows)
        return pd.Series(out)

    rows = docs.select(position.alias("pos"), F.col(id_col).alias("id"),
                       text_of(text_col).alias("text"))
    rows = rows.withColumn("deal", F.explode(dealt("pos"))).select(
        "deal.range", "deal.tail", "pos", "id", "text")
    rows = rows.repartitionById(len(cuts) + 1, F.col("range")).sortWithinPartitions(
        "range", "tail", "pos", "text")

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            out = []
            for at, tail, missing, id_, text in zip(
                    frame["range"], frame["tail"], frame["pos"] == LEAST_ID, frame["id"],
                    frame["text"]):
                now = (at, tail, None if missing else int(id_), text, prepare(text))
                if held and held[0] == at and not held[1]:
                    out.append(visit(*held[2:], *now[3:]))
                held = now
            yield pd.DataFrame(out, columns=names)

    names = [part.split()[0] for part in schema.split(", ")]
    return rows.mapInPandas(walk, schema)


def edit(text: str, other: str) -> str:
    """Text whose last quarter gives way to the start of another."""
    cut = len(text) // 4
    return text[:len(text) - cut] + other[:cut]


def drift(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sketches of every document and of its edited text, and how alike they are."""
    def visit(id_, text, own, other, others):
        edited = edit(text, other)
        edited_own = own if edited == text else sketch(edited)
        return (id_, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own),
                written(edited_own), likeness(own, edited_own), likeness(own, others))

    schema = (f"{id_col} long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
    return beside(docs, visit, schema, id_col, text_col, sketch)


@query("op8_sketches")
def op8_sketches(spark: SparkSession, folder: str) -> DataFrame:
    return drift(table(spark, folder, "documents"))
