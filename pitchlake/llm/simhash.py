"""SimHash near-duplicates, linked by BK-trees over shards of fingerprints.

Every text becomes one 64-bit fingerprint, equal fingerprints become one node. Two
fingerprints within r bits agree on at least one of the ways to leave out r of b bit blocks.
So the nodes are dealt, once per way, into shards by the bits of the other blocks, and each
shard gets a BK-tree whose children hang on edges marked with their integer Hamming distance.
A probe follows only the edges within the radius of its own distance. The trees meet their
probes by a shuffle and not by a broadcast: every probe goes only to the shards that can hold
a partner, where a broadcast of all trees would let it walk all of them.

Shards that hold many nodes are cut into pieces of bounded size, and each pair of pieces is
one tree with its probes. Within a tree, links are reduced to a spanning forest at once.

Defined results: null, empty and blank texts have no words, fingerprint zero, and link like
any other; a text of fewer words than a shingle is one shingle; repeated rows and ties share a
component; a null id gets a fingerprint and the component of it, named by the smallest id that
is not null (null if there is none); an empty table gives an empty result; only the id and
text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from pitchlake.llm.common import query, settle, table
from pitchlake.llm.components import components

BITS = 64
# Most nodes of one tree; a larger shard is cut into pieces.
TREE_NODES = 4_096
# Nodes that a shard should hold on average; more blocks make shards smaller.
SHARD_NODES = 512


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Majority of each bit over the hashes of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    one = xxhash.xxh64_intdigest
    hashes = np.fromiter((one(s, seed) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = hashes[start:start + 65_536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(),
                          "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """Columns id and fp, the fingerprint as signed 64-bit integer."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, width) for t in texts), np.uint64, len(texts))
        return pd.Series(values.view(np.int64))

    return docs.select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("fp"))


class BKTree:
    """Metric tree over distinct fingerprints; edges carry the distance to the parent."""

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes
        self.children: list[dict[int, int]] = [{} for _ in nodes]
        values = nodes.tolist()
        for i in range(1, len(values)):
            at, value = 0, values[i]
            while True:
                distance = (values[at] ^ value).bit_count()
                below = self.children[at].get(distance)
                if below is None:
                    self.children[at][distance] = i
                    break
                at = below

    def within(self, probes: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """Node and the probes within the radius, all probes walking down together."""
        stack = [(0, np.arange(len(probes)))] if len(self.nodes) else []
        while stack:
            at, active = stack.pop()
            distance = np.bitwise_count(probes[active] ^ self.nodes[at]).astype(np.int16)
            hit = active[distance <= radius]
            if hit.size:
                yield at, hit
            for edge, child in self.children[at].items():
                near = active[np.abs(distance - edge) <= radius]
                if near.size:
                    stack.append((child, near))


def forest(nodes: np.ndarray, probes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between nodes and probes, as two arrays of fingerprints."""
    values = np.concatenate([nodes, probes])
    parent = np.arange(len(values))
    shift = len(nodes)
    for at, hits in BKTree(nodes).within(probes, radius):
        group = np.append(hits + shift, at)
        roots = parent[group]
        while True:
            above = parent[roots]
            if np.array_equal(above, roots):
                break
            roots = above
        least = roots.min()
        parent[roots] = least
        parent[group] = least
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            break
        parent = above
    moved = values != values[parent]
    return values[moved], values[parent][moved]


def blocks_for(nodes: int, radius: int, target: int = SHARD_NODES) -> int:
    """Fewest blocks with shards of about the target size on evenly spread fingerprints."""
    blocks = radius + 1
    while nodes / 2 ** (BITS * (blocks - radius) // blocks) > target and blocks < 2 * radius + 2:
        blocks += 1
    return blocks


def masks(radius: int, blocks: int) -> list[int]:
    """Bit masks of all choices of blocks that remain when ``radius`` blocks are left out."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    chosen = [sum(c) for c in combinations(whole, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def links(nodes: DataFrame, radius: int, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Edges a, b that connect exactly what links within the radius connect.

    ``nodes`` has distinct values in column fp and is read more than once.
    """
    ways = masks(radius, blocks_for(nodes.count(), radius))
    shards = nodes.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("way"), F.col("fp").bitwiseAND(F.lit(m)).alias("part"))
        for i, m in enumerate(ways)])).alias("s")).select("fp", "s.way", "s.part")
    sizes = (shards.groupBy("way", "part").count().filter("count > 1")
             .select("way", "part", F.ceil(F.col("count") / tree_nodes).alias("pieces")))
    x, n = F.col("piece"), F.col("pieces")
    placed = shards.join(sizes, ["way", "part"]).withColumn(
        "piece", F.pmod(F.xxhash64("fp"), n))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    dealt = dealt.select(
        "way", "part", F.least(x, "other").alias("i"), F.greatest(x, "other").alias("j"),
        (x <= F.col("other")).alias("tree"), (x >= F.col("other")).alias("probe"), "fp")
    key = ["way", "part", "i", "j"]
    return (dealt.repartition(*key).sortWithinPartitions(*key)
            .mapInPandas(lambda frames: _link(frames, radius), "a long, b long"))


def _link(frames: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Walk sorted groups; a group that goes on in the next frame waits for it."""
    rest: list[pd.DataFrame] = []
    last = None
    for frame in frames:
        if frame.empty:
            continue
        first = tuple(frame.iloc[0, :4])
        ends = _ends(frame)
        if rest and first != last:
            yield _forests(pd.concat(rest), radius)
            rest = []
        if len(ends) > 1:
            cut = ends[-2]
            yield _forests(pd.concat([*rest, frame.iloc[:cut]]), radius)
            rest = [frame.iloc[cut:]]
        else:
            rest.append(frame)
        last = tuple(frame.iloc[-1, :4])
    if rest:
        yield _forests(pd.concat(rest), radius)


def _ends(frame: pd.DataFrame) -> np.ndarray:
    """Positions after the last row of each group of equal keys."""
    changed = np.zeros(len(frame) - 1, bool)
    for name in ("way", "part", "i", "j"):
        column = frame[name].to_numpy()
        changed |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(changed) + 1, len(frame))


def _forests(frame: pd.DataFrame, radius: int) -> pd.DataFrame:
    values = frame["fp"].to_numpy().view(np.uint64)
    tree, probe = frame["tree"].to_numpy(), frame["probe"].to_numpy()
    left, right, start = [], [], 0
    for end in _ends(frame):
        part = values[start:end]
        a, b = forest(part[tree[start:end]], part[probe[start:end]], radius)
        left.append(a)
        right.append(b)
        start = end
    return pd.DataFrame({"a": np.concatenate(left).view(np.int64),
                         "b": np.concatenate(right).view(np.int64)})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = 3, radius: int = 3) -> DataFrame:
    """One row per input row: id, fp and component_id, the smallest id reachable by links."""
    prints = settle(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = settle(prints.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    found = components(links(nodes, radius))
    rooted = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


@query("op3_simhash_dedup")
def op3_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
