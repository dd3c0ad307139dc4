"""Stages of the pipeline on repeated rows and null ids, against brute force."""

from collections import Counter

import pytest

import corpus_pipeline as pipeline
from pitchlake.llm import mixing
from pitchlake.llm.common import session, settle

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 30
ROWS = [
    (1, "one text", "a"), (1, "one text", "a"), (1, "another text", "a"), (2, "another  text", "b"),
    (None, "no id", "a"), (None, "no id", "b"), (None, "one text", "a"), (3, None, "b"), (3, "", "b"),
    (None, "only here", None), (None, LONG, "a"), (None, LONG + "end", "a"), (4, LONG + "ends", "b"),
    (4, "something else entirely", "b"),
]


@pytest.fixture(scope="module")
def stored(spark):
    rows = session(spark).createDataFrame(ROWS, "doc_id long, text string, source string")
    return settle(rows.repartition(3), "stage-input")


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def smallest(group):
    return min(((r[0] is None, r[0] or 0) for r in group))


def groups_of(rows, key):
    groups = {}
    for row in rows:
        groups.setdefault(key(row), []).append(row)
    return groups


def check_one_of_each(got, groups):
    assert sum(got.values()) == len(groups)
    for group in groups.values():
        kept = [r for r in got if r in group]
        assert len(kept) == 1 and got[kept[0]] == 1
        assert (kept[0][0] is None, kept[0][0] or 0) == smallest(group)


def test_drop_copies(spark, stored):
    groups = groups_of(ROWS, lambda r: " ".join((r[1] or "").split()))
    check_one_of_each(rows_of(pipeline.drop_copies(spark, stored, "")), groups)


def test_drop_near_copies(spark, stored):
    from pitchlake.llm.simhash import fingerprint
    prints = sorted({fingerprint(r[1]) for r in ROWS})
    root = {p: p for p in prints}
    for _ in prints:
        for p in prints:
            root[p] = min(root[q] for q in prints if (p ^ q).bit_count() <= 3)
    groups = groups_of(ROWS, lambda r: root[fingerprint(r[1])])
    assert len(groups) < len({r[1] for r in ROWS})
    check_one_of_each(rows_of(pipeline.drop_near_copies(spark, stored, "")), groups)


@pytest.mark.parametrize("ids", [lambda i: i % 3, lambda i: None])
def test_mix_sources(spark, ids):
    rows = [(ids(i), "w " * (i % 20 + 1), "aaaaaabbbc"[i % 10]) for i in range(600)]
    docs = settle(session(spark).createDataFrame(
        rows, "doc_id long, text string, source string").repartition(3), "mix-input")
    plan = mixing.mix(docs).collect()
    aims = {r["source_size"]: r["target"] for r in plan}
    sizes, taken = Counter(), Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    for r in pipeline.mix_sources(spark, docs, "").collect():
        taken[r["source"]] += len(r["text"].split())
    assert len(set(sizes.values())) == 3
    assert all(abs(taken[s] - aims[sizes[s]]) <= 20 for s in sizes)
