"""Language identification by prediction by partial matching over bytes.

Every language has a tree of byte contexts up to ``CONTEXT`` bytes with the counts of the
bytes that followed. The code length of a byte in a context is -log2 of its share there; where
it has not been seen the escape of the context is paid and the next shorter context asked,
down to all 256 bytes alike (escape method C: as many escapes as distinct bytes). Statistics
are frozen after learning, so a text costs a sum over its bytes, and the language under which
the whole text is shortest wins.

Learning reads at most ``SAMPLE`` whole documents of each language, chosen by a hash of the
id, and no further one once they have ``SAMPLE_BYTES`` bytes, with every sequence of
``CONTEXT`` + 1 bytes in them. Trees are kept by blocks of ``BLOCK`` languages, so that a
sequence costs room for the languages of its block only; there may be any number of blocks.
Every text is then scored whole.

Defined results: a null text and one without a letter are ``und`` with score 0, as is every
text when nothing can be learnt; on a tie the smaller language name wins; rows without a
language or a text teach nothing; repeated rows and equal texts get equal results; an empty table gives
an empty result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from pitchlake.llm.common import held_out, query, settle, table

CONTEXT = 4
# Most documents and bytes per language that the statistics are learnt from.
SAMPLE = 1_500
SAMPLE_BYTES = 8_000_000
# Ranks are taken within so many parts of a language first; Spark picks up to 1,000 rows of a
# part within each task before it shuffles, however large the language.
PARTS = 16
PART_ROWS = 1_000
# Languages whose trees share one table of sequences.
BLOCK = 8
# Bytes scored at once; longer texts are scored in pieces that know the bytes before them.
PIECE = 1 << 20
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
START = b"\n" * CONTEXT


def windows(text: bytes) -> np.ndarray:
    """For every byte a number of itself (lowest) and the CONTEXT bytes before it."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    value = np.zeros(len(raw) - CONTEXT, np.uint64)
    for i in range(CONTEXT + 1):
        value = (value << np.uint64(8)) | raw[i:len(raw) - CONTEXT + i]
    return value


def low(keys: np.ndarray, length: int) -> np.ndarray:
    return keys & np.uint64((1 << (8 * length)) - 1)


class Places:
    """Hash table from numbers to their positions, looked up for many at once."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        self.probes = 0
        left = np.arange(len(keys))
        while left.size:
            slots = self._slots(keys[left], self.probes)
            free, first = np.unique(slots, return_index=True)
            first = first[self.rows[free] < 0]
            slots, taken = slots[first], left[first]
            self.keys[slots], self.rows[slots] = keys[taken], taken
            left = np.delete(left, first)
            self.probes += 1

    def _slots(self, keys: np.ndarray, probe: int) -> np.ndarray:
        mixed = (keys + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        home = (mixed >> np.uint64(64 - self.bits)).astype(np.int64)
        return (home + probe) & ((1 << self.bits) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each number, -1 where it is not held."""
        slots = self._slots(keys, 0)
        rows = self.rows[slots]
        rows[(rows >= 0) & (self.keys[slots] != keys)] = -2
        for probe in range(1, self.probes):
            open_ = np.flatnonzero(rows == -2)
            if not open_.size:
                break
            asked = keys[open_]
            slots = self._slots(asked, probe)
            got = self.rows[slots]
            got[(got >= 0) & (self.keys[slots] != asked)] = -2
            rows[open_] = got
        rows[rows < 0] = -1
        return rows


@dataclass
class Trees:
    """Context trees of all languages.

    ``costs[m]`` has the code length, per language, of each known sequence's last byte after
    the others (m of them); ``escapes[m]`` the escape of each known context of m bytes.
    """
    languages: list[str]
    sequences: list[Places]
    costs: list[np.ndarray]
    contexts: list[Places]
    escapes: list[np.ndarray]

    def code_length(self, text: bytes) -> np.ndarray:
        """Bits of a text under every language."""
        total = np.zeros(len(self.languages))
        padded = START + text
        for start in range(0, len(text), PIECE):
            keys = windows(padded[start:start + PIECE + CONTEXT])
            for m in range(CONTEXT, -1, -1):
                rows = self.sequences[m].find(low(keys, m + 1))
                known = rows[rows >= 0]
                if known.size:
                    total += self.costs[m][known].sum(axis=0, dtype=float)
                keys = keys[rows < 0]
                if not keys.size:
                    break
                at = self.contexts[m].find(low(keys >> np.uint64(8), m))
                at = at[at >= 0]
                if at.size:
                    total += self.escapes[m][at].sum(axis=0, dtype=float)
            total += 8.0 * len(keys)
        return total


@dataclass
class Forest:
    """Trees of all languages, in the order of their names."""
    blocks: list[Trees]

    @property
    def languages(self) -> list[str]:
        return [name for trees in self.blocks for name in trees.languages]

    def code_length(self, text: bytes) -> np.ndarray:
        """Bits of a text under every language."""
        return np.concatenate([trees.code_length(text) for trees in self.blocks])

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.blocks or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        bits = self.code_length(text.encode())
        best = int(bits.argmin())
        return self.languages[best], float(1 / np.exp2(np.clip(bits[best] - bits, -500, 0)).sum())


def grow(counts: pd.DataFrame, languages: list[str]) -> Trees:
    """Trees from the counts of whole windows: columns which (the language's place), key, n."""
    which = counts["which"].to_numpy(int)
    keys, n = counts["key"].to_numpy().astype(np.uint64), counts["n"].to_numpy(float)
    trees = Trees(languages, [], [], [], [])
    shorter = None
    for m in range(CONTEXT + 1):
        held, at = np.unique(low(keys, m + 1), return_inverse=True)
        seen = np.zeros((len(held), len(languages)))
        np.add.at(seen, (at, which), n)
        context, of = np.unique(held >> np.uint64(8), return_inverse=True)
        total = np.zeros((len(context), len(languages)))
        distinct = np.zeros_like(total)
        np.add.at(total, of, seen)
        np.add.at(distinct, of, (seen > 0).astype(float))
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
            direct = np.log2((total + distinct)[of] / seen)
        if shorter is None:
            below = np.full(seen.shape, 8.0)
        else:
            below = shorter[1][shorter[0].find(low(held, m))]
        cost = np.where(seen > 0, direct, escape[of] + below)
        places = Places(held)
        trees.sequences.append(places)
        trees.costs.append(cost.astype(np.float32))
        trees.contexts.append(Places(context))
        trees.escapes.append(escape.astype(np.float32))
        shorter = (places, cost)
    return trees


def chosen(named: DataFrame, size: int, most: int) -> DataFrame:
    """Ids and languages of the documents to learn from, of a table ``(id, lang, text)``."""
    order = F.xxhash64("id")
    ids = named.select("id", "lang", F.octet_length("text").alias("bytes"),
                       F.pmod(F.xxhash64(F.lit("part"), "id"), F.lit(PARTS)).alias("part"))
    part = Window.partitionBy("lang", "part").orderBy(order, "id", "bytes")
    some = ids.withColumn("rank", F.row_number().over(part)).filter(
        F.col("rank") <= min(size, PART_ROWS)).drop("rank")
    whole = Window.partitionBy("lang").orderBy(order, "id", "bytes")
    ranked = some.withColumns({
        "rank": F.row_number().over(whole),
        "before": F.sum("bytes").over(whole.rowsBetween(Window.unboundedPreceding, -1))})
    return ranked.filter((F.col("rank") <= size) & (F.coalesce("before", F.lit(0)) < most)).select(
        "id", "lang")


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", size: int = SAMPLE, most: int = SAMPLE_BYTES,
          block: int = BLOCK) -> Forest:
    """Trees from at most ``size`` documents of each language."""
    named = docs.filter(F.col(lang_col).isNotNull() & (F.col(text_col) != "")
                        & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    ids = settle(chosen(named, size, most), "language-sample")
    # One name per language.
    languages = sorted(r["lang"] for r in ids.select("lang").distinct().collect())
    # Of repeated rows of an id, one text.
    sample = settle(named.join(ids.distinct(), ["id", "lang"]).groupBy("id", "lang")
                    .agg(F.max("text").alias("text")).select("lang", "text"), "language-texts")

    def count(place: dict[str, int]):
        def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for lang, texts in frame.groupby("lang")["text"]:
                    keys = np.concatenate([windows(START + t.encode()) for t in texts])
                    held, n = np.unique(keys, return_counts=True)
                    yield pd.DataFrame({"which": place[lang], "key": held.astype(np.int64), "n": n})
        return work

    blocks = []
    for first in range(0, len(languages), block):
        names = languages[first:first + block]
        place = {lang: i for i, lang in enumerate(names)}
        part = sample.filter(F.col("lang").isin(names)).mapInPandas(
            count(place), "which int, key long, n long")
        # Bounded by the bytes of the samples of a block.
        counts = part.groupBy("which", "key").agg(F.sum("n").alias("n")).toPandas()
        blocks.append(grow(counts, names))
    return Forest(blocks)


def identify(docs: DataFrame, trees: Forest, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (the posterior of the language)."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        model = shared.value
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score"])

    out = docs.select(F.col(id_col), predict(F.col(text_col)).alias("__found"))
    return out.select(id_col, "__found.lang_pred", "__found.score")


@query("op2_language_id")
def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trees = learn(docs.filter(~held_out("doc_id")))
    return identify(docs, trees).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
