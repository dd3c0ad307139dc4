"""Registered queries of the corpus operators."""

from pitchlake.llm import (  # noqa: F401
    bpe, exact, language, mixing, resampling, rollups, rules, sharding, simhash, sketches, toxicity,
    warc, whitening)
from pitchlake.llm.common import ORACLES, QUERIES  # noqa: F401
