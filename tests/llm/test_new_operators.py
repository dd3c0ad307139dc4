"""Quality rules, whitening and resampling on odd inputs, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitchlake.llm import resampling, rules, whitening
from pitchlake.llm.common import session, settle
from tests.llm.test_operators import TEXTS, rows_of


@pytest.fixture(scope="module")
def docs(spark):
    return settle(rows_of(spark), "odd")


def brute_counts(text):
    words = re.findall("[^ \t-\r]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search("[^ \t-\r]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), len(lines))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def random_texts(seed, how_many=60):
    draw = random.Random(seed)
    for _ in range(how_many):
        words = [draw.choice(["a", "b", "#", "ä𝄞", "a|b", "w%d" % draw.randrange(50)])
                 for _ in range(draw.randrange(0, 90))]
        yield "".join(w + draw.choice([" ", " ", "\n", "\t ", "\v"]) for w in words)


def test_rule_counts(spark, docs):
    texts = [t for _, t, *_ in TEXTS] + list(random_texts(1))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: tuple(r[c] for c in COUNTS) for r in rules.counts(rows, ["id"]).collect()}
    assert got == {i: brute_counts(t) for i, t in enumerate(texts)}


def test_repeated_words_despite_equal_hashes(spark, monkeypatch):
    """With one hash for all windows, whole windows are compared."""
    texts = list(random_texts(2, 30))
    monkeypatch.setattr(rules.F, "xxhash64", lambda *columns: F.lit(0).cast("long"))
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    words = F.split(F.trim("text"), " +")
    found = rows.select("id", words.alias("w"), rules.repeated_words(words).alias("n")).collect()
    for r in found:
        seen = Counter(tuple(r["w"][i:i + 3]) for i in range(len(r["w"]) - 2))
        hit = {i + k for i in range(len(r["w"]) - 2) if seen[tuple(r["w"][i:i + 3])] > 1
               for k in range(3)}
        assert r["n"] == len(hit)


def test_bins(spark):
    values = [*range(300), 999, 1_000, 123_456, 10 ** 9, 10 ** 15]
    rows = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", rules.bin_of(F.col("v")).alias("b"))
    got = rows.withColumn("low", rules.least_of(F.col("b"))).orderBy("v").collect()
    assert [r["b"] for r in got] == sorted(r["b"] for r in got)
    assert all(r["low"] <= r["v"] < (r["low"] + 1) * (1 + 2 ** -(rules.BITS - 1)) for r in got)
    assert all(r["low"] == r["v"] for r in got if r["v"] < 1 << rules.BITS)


def test_sketches_merge_like_one(spark):
    rows = [("d", "s%d" % (i % 7), 40 + i % 13, 100, 3, i % 4, 1, 0) for i in range(400)]
    schema = ("lang string, source string, n_words long, word_chars long, n_lines long,"
              "n_dup_lines long, n_symbols long, n_repeat_words long")
    df = spark.createDataFrame(rows, schema)
    parts = rules.merged(rules.sketches(df), ["lang"])
    whole = rules.sketches(df.withColumn("source", F.lit("one"))).drop("source")
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect()))


def story(draw, length=80, word=5):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(word)) for _ in range(length))


def test_fences_follow_the_group(spark):
    """What is usual in one source is odd in another; small groups take the fences above them."""
    draw = random.Random(5)
    rows = []
    for i in range(240):
        text = story(draw)
        rows.append((i, text, "en", "prose", "clash"))
        rows.append((1000 + i, text.replace(" ", " # "), "en", "code", "clash"))
    rows += [(5000, story(draw).replace(" ", " # "), "en", "prose", "c"),
             (5001, story(draw).replace(" ", " # "), "en", "code", "c"),
             (5002, story(draw, word=20), None, None, "c"), (5003, story(draw), "de", "tiny", "c"),
             (5004, None, "en", "prose", "c"), (5004, None, "en", "prose", "c"),
             (None, "same words again " * 60, "en", "prose", "c")]
    df = session(spark).createDataFrame(rows, "doc_id long, text string, lang string, source string, fences string")
    out = rules.judge(df).collect()
    assert len(out) == len(rows)
    kept = {r["doc_id"]: r["kept"] for r in out}
    assert all(kept[i] and kept[1000 + i] for i in range(240))
    assert (kept[5000], kept[5001], kept[5002], kept[5003]) == (False, True, False, True)
    assert not kept[5004] and not kept[None]
    assert {tuple(r["failed"]) for r in out if r["base_failed"]} == {("base",)}


def test_rules_on_odd_rows(spark, docs):
    out = rules.judge(docs).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(i) for i, *_ in TEXTS)
    assert rules.judge(docs.limit(0)).collect() == []


VECTORS = "vec_id long, embedding array<float>, label int, id string, n long, vector string"


def vectors(spark, rows):
    return session(spark).createDataFrame([(i, v, 0, "c", 7, "c") for i, v in rows], VECTORS)


def expected(rows):
    x = np.floor(1024 * np.array(rows, np.float32).astype(float)) + 100_000
    centred = x - x.mean(axis=0)
    return x, centred, np.linalg.eigh(centred.T @ centred / len(x))


@pytest.mark.parametrize("shape,components", [((300, 12), 8), ((40, 5), 8), ((6, 9), 8), ((200, 3), 2)])
def test_whitening(spark, shape, components):
    draw = np.random.default_rng(3)
    rows = (draw.normal(size=shape) @ draw.normal(size=(shape[1], shape[1]))).astype(np.float32)
    bad = [(900, None), (901, [None] * shape[1]), (902, [float("nan")] * shape[1]),
           (903, [1.0] * (shape[1] - 1) + [float("inf")]), (904, [1.0] * (shape[1] + 1)), (905, [])]
    df = vectors(spark, [(i, r.tolist()) for i, r in enumerate(rows)] + bad).repartition(5)
    out = whitening.whitened(df, components=components).toPandas()
    x, centred, (values, basis) = expected(rows)
    rank = int((values > 1e-6 * values.max()).sum())
    many = min(components, rank)
    assert len(out) == len(rows) * many and set(out["n"]) == {len(rows)}
    sums = x.sum(axis=0).astype(int)
    for k in range(many):
        part = out[out["component"] == k + 1].sort_values("vec_id")
        want = centred @ basis[:, -1 - k] / np.sqrt(values[-1 - k])
        got = part["whitened"].to_numpy()
        assert np.allclose(got, want * np.sign(want @ got), atol=1e-8)
        assert np.allclose(part["explained"], values[-1 - k] / values.sum(), rtol=1e-9)
        exact = [int(sum((len(rows) * int(a) - int(s)) ** 2 for a, s in zip(r, sums))) for r in x]
        assert part["deviation"].astype(object).map(int).tolist() == exact
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-8


def test_whitening_without_variance(spark):
    assert whitening.whitened(vectors(spark, [])).collect() == []
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0])] * 4)).collect() == []
    assert whitening.whitened(vectors(spark, [(1, None), (2, [])])).collect() == []
    flat = whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (1, [1.0, 4.0]), (None, [1.0, 2.0])]))
    assert [(r["vec_id"], r["component"], r["explained"]) for r in flat.orderBy("vec_id").collect()] == [
        (None, 1, 1.0), (1, 1, 1.0), (1, 1, 1.0)]
    with pytest.raises(Exception, match="beyond"):
        whitening.whitened(vectors(spark, [(1, [1e30, 0.0])])).collect()


def test_factor_and_rotations():
    draw = np.random.default_rng(9)
    for width, rank in ((1, 1), (7, 7), (16, 5), (33, 33)):
        root = draw.normal(size=(width, rank)) * 10.0 ** draw.integers(-3, 4, size=rank)
        matrix = root @ root.T
        factor = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] <= width and np.allclose(factor @ factor.T, matrix, atol=1e-10 * matrix.max())
        order = np.argsort([np.flatnonzero(r)[-1] if r.any() else width for r in factor], kind="stable")
        assert np.allclose(np.triu(factor[order][:factor.shape[1]], 1), 0)
        values, basis = whitening.decompose(matrix)
        assert np.allclose(basis.T @ basis, np.eye(len(values)), atol=1e-12)
        assert np.allclose(matrix @ basis, basis * values, atol=1e-11 * matrix.max())


def test_exact_sums():
    wide = np.array([[2 ** 31, -2 ** 31], [2 ** 31, 5]], np.int64)
    assert whitening.gram(wide).tolist() == [[2 * 2 ** 62, -2 ** 62 + 5 * 2 ** 31],
                                             [-2 ** 62 + 5 * 2 ** 31, 2 ** 62 + 25]]
    total = whitening.Total((1,))
    for _ in range(5):
        total.add(np.array([2 ** 61], np.int64))
    total.add(np.array([2 ** 70], object))
    assert [int(v) for v in total.rows()["v"]] == [5 * 2 ** 61 + 2 ** 70]


def brute_resample(texts, target, buckets, longest, least_words, percent):
    def features(text):
        words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
        return words, [zlib.crc32(b" ".join(words[i:i + n])) % buckets
                       for n in range(1, longest + 1) for i in range(len(words) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in texts:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    here, there = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (here + buckets) / ((s[b] + 1) * (there + buckets))))
            for b in range(buckets)]
    rows = []
    for i, text in texts:
        words, found = features(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))
        rows.append([i, len(found), weight, score, None, len(words)])
    open_ = sorted((r for r in rows if r[5] >= least_words),
                   key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(open_[:percent * len(open_) // 100], 1):
        row[4] = rank
    return sorted([tuple(r[:5]) for r in rows], key=str)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_resampling(spark, longest):
    draw = random.Random(4)
    vocabulary = ["alpha", "Beta", "ÉTÉ", "été", "x1", "y-z", "über", "_q_"]
    texts = [(i, "".join(draw.choice(vocabulary) + draw.choice([" ", " ", "\n", ", ", "\n\n"])
                         for _ in range(draw.randrange(40)))) for i in range(150)]
    texts += [(500 + i, "Beta alpha\nx1 été\n" * 12) for i in range(50)]
    texts += [(1000, None), (1001, ""), (1002, "-- \n ..."), (None, "alpha " * 30), (1003, "w " * 70_000)]
    target = ["alpha x1\nBeta", None, "", "alpha alpha alpha"]
    df = session(spark).createDataFrame([(i, t, "c", 0) for i, t in texts],
                                        "doc_id long, text string, line string, row long").repartition(3)
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    out = resampling.resample(df, aim, buckets=50, longest=longest, least_words=5, percent=30)
    assert sorted(map(tuple, out.collect()), key=str) == brute_resample(texts, target, 50, longest, 5, 30)


def test_resampling_of_repeated_rows(spark):
    rows = [(7, "one two three")] * 30 + [(None, "one two three")] * 30
    df = session(spark).createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    out = resampling.resample(df, none, least_words=3, percent=50).collect()
    ranks = sorted(r["rank"] for r in out if r["rank"])
    assert len(out) == 60 and ranks == list(range(1, 31))
    assert len({r["doc_id"] for r in out if r["rank"]}) == 1
    assert resampling.resample(df.limit(0), none).collect() == []


def test_toxicity_of_few_separable_documents(spark):
    """Twenty of each kind that one word tells apart: all are told apart, none for lack of evidence."""
    from pitchlake.llm import toxicity
    draw = random.Random(8)
    texts = [(i, story(draw, 30) + (" idiot " if i % 2 else " friend ") + story(draw, 30), "en", "s")
             for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    model = toxicity.fit(rows_of(spark, texts), labels)
    assert all((model.score(t) >= 0.5) == bool(i % 2) for i, t, *_ in texts)
    fresh = [story(draw, 20) + w + story(draw, 20) for w in (" idiot ", " friend ")]
    assert model.score(fresh[0]) > model.score(fresh[1])
    # A rare class is sampled whole, a common one up to the bound, and the bias makes up for it.
    many = [(i, story(draw, 10) + (" idiot" if i < 6 else " friend"), "en", "s") for i in range(300)]
    rare = spark.createDataFrame([(i, int(i < 6)) for i in range(300)], "doc_id long, toxic int")
    small = toxicity.fit(rows_of(spark, many), rare, size=50)
    assert sum(small.score(t) >= 0.5 for _, t, *_ in many) == 6


def test_ratios_against_brute_force(spark):
    from pitchlake.llm import toxicity
    rows = [(0, "aab"), (0, "aabb"), (1, "abab"), (1, "aab aab")]
    found = spark.createDataFrame(
        [(label, *[x.tolist() for x in toxicity.counts_of(t)]) for label, t in rows],
        "label int, bins array<int>, counts array<int>")
    got = toxicity.ratios(toxicity.class_counts(found), 2, 2, kept=10_000)
    seen = {}
    for label, text in rows:
        for b in set(toxicity.counts_of(text)[0].tolist()):
            seen.setdefault(b, [0, 0])[label] += 1
    for b, (clean, toxic) in seen.items():
        p, q = toxic + 0.5, clean + 0.5
        r = math.log(p / 3) - math.log(q / 3)
        assert got[b] == pytest.approx(r ** 3 / (r * r + 9 * (1 / p + 1 / q)))
    assert np.count_nonzero(got) <= len(seen)
    few = toxicity.ratios(toxicity.class_counts(found), 2, 2, kept=3)
    assert np.count_nonzero(few) <= 3
    text = " aab aab "
    bins, counts = toxicity.counts_of("aab aab")
    grams = Counter(text[i:i + n] for n in toxicity.ORDERS for i in range(len(text) - n + 1))
    assert sorted(counts.tolist()) == sorted(grams.values()) and len(bins) == len(grams)


def test_regression_against_plain_descent():
    from pitchlake.llm import toxicity
    draw = np.random.default_rng(2)
    bins = [np.sort(draw.choice(30, 6, replace=False)).astype(np.int32) for _ in range(80)]
    counts = [draw.integers(1, 4, 6).astype(np.int32) for _ in bins]
    labels = np.array([int(3 in b) for b in bins])
    scale = np.zeros(toxicity.BINS)
    scale[:30] = draw.normal(size=30)
    weights, bias = toxicity.regress(bins, counts, labels, scale)
    x = np.zeros((80, 30))
    for i, (b, n) in enumerate(zip(bins, counts)):
        x[i, b] = scale[b] * np.log1p(n)
    x /= np.sqrt((x ** 2).sum(axis=1, keepdims=True))

    def cost(w, c):
        margin = x @ w + c
        return (np.logaddexp(0, margin) - labels * margin).mean() + toxicity.RIDGE / 2 * w @ w

    w, c = np.zeros(30), 0.0
    for _ in range(20_000):
        error = 1 / (1 + np.exp(-(x @ w + c))) - labels
        w, c = w - 2 * (x.T @ error / 80 + toxicity.RIDGE * w), c - 2 * error.mean()
    assert cost(weights[:30], bias) <= cost(w, c) + 1e-4
