"""Every registered corpus query on the smallest tables: its columns, its rows, its SQL."""

import hashlib
import math
import zlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_file
from pitchlake.llm.catalog import ORACLES, QUERIES
from tools.compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no generated tables")

COLUMNS = {
    "op1": "doc_id size text_crc32 law shard slot grown_shard",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id fingerprint component_id",
    "op4": "doc_id held_out score predicted",
    "op5": "page_id payload_bytes payload_digest record_type refers_to",
    "op6": "source lang version docs tokens",
    "op7": "doc_id keep_id group_size kept text_sha256",
    "op8": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9": "doc_id size source_size target taken",
    "op10": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op11": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op12": "vec_id component n deviation whitened explained identity_error",
    "op13": "doc_id n_features weight score rank",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def results(spark):
    """Rows of a query, run once."""
    known = {}

    def of(op):
        name = next(n for n in QUERIES if n.startswith(f"{op}_"))
        if op not in known:
            df = entry_file.queries()[name](spark, FOLDER)
            known[op] = name, df.columns, [tuple(r) for r in df.collect()]
        return known[op]

    return of


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.sql("select doc_id, coalesce(text, '') from documents").fetchall())


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in entry_file.queries()


@pytest.mark.parametrize("op", COLUMNS)
def test_query(db, results, op):
    name, columns, rows = results(op)
    assert set(COLUMNS[op].split()) <= set(columns)
    if columns[0] == "doc_id":
        ids = db.sql("select doc_id from documents").fetchall()
        assert sorted(str(r[0]) for r in rows) == sorted(str(i) for i, in ids)
    if name in ORACLES:
        expected = db.sql(ORACLES[name])
        assert sorted(columns) == sorted(expected.columns)
        assert rows_of(columns, rows) == rows_of(expected.columns, expected.fetchall())


def by_id(results, op):
    _, columns, rows = results(op)
    return {r[0]: dict(zip(columns, r)) for r in rows}


def test_sharding(results, texts):
    rows = by_id(results, "op1")
    for i, r in rows.items():
        raw = texts[i].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))
        assert r["grown_shard"] in (r["shard"], 16)
    for shard in {r["shard"] for r in rows.values()}:
        slots = sorted(r["slot"] for r in rows.values() if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_simhash(results, texts):
    rows = by_id(results, "op3")
    prints = {i: int(r["fingerprint"], 16) for i, r in rows.items()}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= 3:
                    root[a], changed = root[b], True
    assert {i: r["component_id"] for i, r in rows.items()} == root


def test_toxicity_and_language_have_their_folds(results):
    for op in ("op2", "op4"):
        for i, r in by_id(results, op).items():
            assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
            assert op == "op2" or r["predicted"] == int(r["score"] >= 0.5)


def test_sketches(results, texts):
    order, rows = sorted(texts), by_id(results, "op8")
    likely = []
    for n, i in enumerate(order):
        text, after = texts[i], texts[order[(n + 1) % len(order)]]
        cut = len(text) // 4
        edited = text[:len(text) - cut] + after[:cut]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(rows[i]["fingerprint"]) < max(11, len(text)) and rows[i]["n_chars"] == len(text)
        if len(text) > 500:
            likely.append((rows[i]["near_edited"], rows[i]["near_next"]))
    assert sum(a > 0.5 for a, _ in likely) > 0.95 * len(likely)
    assert sum(b < 0.3 for _, b in likely) > 0.9 * len(likely)


def test_mixing_comes_near_its_targets(results):
    sources = {}
    for r in by_id(results, "op9").values():
        assert 0 <= r["taken"] <= 2 * r["size"]
        target, taken, most = sources.get(r["source_size"], (r["target"], 0, 0))
        sources[r["source_size"]] = target, taken + r["taken"], max(most, r["size"])
    total = sum(sources)
    assert sum(t for t, *_ in sources.values()) == pytest.approx(1.5 * total)
    assert all(abs(taken - target) <= most for target, taken, most in sources.values())


def test_bpe_round_trip(results, texts):
    for i, r in by_id(results, "op10").items():
        assert r["decoded_sha256"] == hashlib.sha256(texts[i].encode()).hexdigest()


def test_rules_keep_clean_documents(spark, results):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = by_id(results, "op11")
    clean = [rows[i] for i, q in labels.items() if q == 1 and i in rows and not rows[i]["base_failed"]]
    junk = [rows[i] for i, q in labels.items() if q == 0 and i in rows]
    assert sum(r["kept"] for r in clean) >= 0.9 * len(clean)
    assert sum(not r["kept"] for r in junk) >= 0.5 * len(junk)


def test_whitening_identity(results):
    _, columns, rows = results("op12")
    errors = {r[columns.index("identity_error")] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9
    per = {}
    for r in rows:
        per.setdefault(r[1], []).append(r[columns.index("whitened")])
    assert len(per) == 8
    for values in per.values():
        assert math.fsum(values) / len(values) == pytest.approx(0, abs=1e-9)
        assert math.fsum(v * v for v in values) / len(values) == pytest.approx(1, abs=1e-9)
