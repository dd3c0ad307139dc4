"""Corpus operators on odd inputs, against brute force, round trips and held-out accuracy."""

import hashlib
import math
import re
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitchlake.llm import (
    bpe, exact, language, mixing, rollups, sharding, simhash, sketches, toxicity, warc)
from pitchlake.llm.common import session, settle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, id string"
LONG = "lorem ipsum dolor sit amet " * 4000
TEXTS = [
    (1, "the quick brown fox jumps over the lazy dog", "en", "b"),
    (2, "the  quick\nbrown fox jumps over the lazy dog", "en", "a"),
    (3, None, None, None), (4, "", "de", "a"), (5, " \t\n", "de", None),
    (6, "ä<|endoftext|> 𝄞 's ...　x", "de", "é"), (7, LONG, "en", "a"),
    (8, LONG + "end", None, "a"), (None, "no id at all", "en", "b"), (9, "x", "en", "Z"),
    (9, "x", "en", "Z"), (10, "x", "en", "b"),
]


def rows_of(spark, texts=TEXTS):
    data = [(i, t, lang, s, 0, "clash", "clash") for i, t, lang, s in texts]
    return session(spark).createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return settle(rows_of(spark), "odd")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def hash_of(key):
    whole = xxhash.xxh64_intdigest(("" if key is None else str(key)).encode(), 42)
    return whole.to_bytes(8, "little")


def shard(key, shards):
    def cost(i):
        h = xxhash.xxh64_intdigest(i.to_bytes(4, "little"),
                                   xxhash.xxh64_intdigest(hash_of(key), 42))
        return -math.log(((h >> 11) + 0.5) / 2 ** 53)
    return min(range(shards), key=cost)


def test_sharding(docs, none):
    placed = settle(sharding.assign(docs.select("doc_id"), "doc_id", [1.0] * 4, [1.0] * 5), "p")
    out = sharding.number(placed, "shard", "doc_id", [], bucket_rows=2).collect()
    assert len(out) == len(TEXTS)
    for row in out:
        assert row["shard"] == shard(row["doc_id"], 4)
        assert row["grown_shard"] in (row["shard"], 4)
    for s in {r["shard"] for r in out}:
        slots = sorted(r["slot"] for r in out if r["shard"] == s)
        assert slots == list(range(len(slots)))
    empty = settle(sharding.assign(none.select("doc_id"), "doc_id", [1.0]), "p")
    assert sharding.number(empty, "shard", "doc_id", []).count() == 0


def test_weighted_shards(spark):
    keys = spark.range(4000).withColumnRenamed("id", "k")
    count = {r["shard"]: r["count"] for r in
             sharding.assign(keys, "k", [3.0, 1.0, 0.0]).groupBy("shard").count().collect()}
    assert set(count) == {0, 1} and 2.6 < count[0] / count[1] < 3.4


def expected_copies(texts):
    groups = {}
    for i, t, *_ in texts:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted((str(i), str(least[k]), len(v)) for k, v in groups.items() for i in v)


@pytest.mark.parametrize("digest", [exact.sha256, lambda t: F.unhex(F.lit("00"))])
def test_exact(docs, none, digest):
    out = exact.deduplicate(docs, digest=digest).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"])
                  for r in out) == expected_copies(TEXTS)
    assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in out)
    assert exact.deduplicate(none).count() == 0


def test_exact_state_goes_on(spark, tmp_path):
    state = f"file://{tmp_path}/state"
    exact.deduplicate(rows_of(spark, [(5, "a b", "en", "s"), (6, "c", "en", "s")]), state=state)
    out = exact.deduplicate(rows_of(spark, [(7, "a  b", "en", "s"), (4, "c", "en", "s")]),
                            state=state)
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in out.collect()} == {
        7: (5, 2), 4: (4, 2)}


@pytest.mark.parametrize("stored", [False, True])
def test_exact_state_compares_whole_texts(spark, tmp_path, stored):
    """One digest for all texts, over two calls: earlier content is read by its locator."""
    def batch(rows):
        df = rows_of(spark, [(i, t, "en", "s") for i, t in rows])
        return settle(df.repartition(2), "batch") if stored else df

    def same(text):
        return F.unhex(F.lit("00"))

    def call(rows, name):
        out = exact.deduplicate(batch(rows), state=state, digest=same, batch=name)
        return {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in out.collect()}

    state = f"file://{tmp_path}/state"
    assert call([(5, "a b"), (6, "a b")], "one") == {5: (5, 2), 6: (5, 2)}
    assert call([(7, "a  b"), (4, "c"), (9, "c")], "two") == {7: (5, 3), 4: (4, 2), 9: (4, 2)}


def test_exact_batch_counts_once(spark, tmp_path, monkeypatch):
    """A call that fails after its arrivals are written, and is repeated, counts them once."""
    state = f"file://{tmp_path}/state"
    first = settle(rows_of(spark, [(5, "a", "en", "s"), (6, "a", "en", "s")]), "first")
    real = exact.absorb
    monkeypatch.setattr(exact, "absorb", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        exact.deduplicate(first, state=state, batch="monday")
    monkeypatch.setattr(exact, "absorb", real)
    for _ in range(2):
        out = exact.deduplicate(first, state=state, batch="monday").collect()
        assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in out) == [(5, 5, 2), (6, 5, 2)]
    more = settle(rows_of(spark, [(1, "a", "en", "s")]), "more")
    assert [(r["keep_id"], r["group_size"]) for r in exact.deduplicate(
        more, state=state, batch="tuesday").collect()] == [(1, 3)]


def test_simhash_odd_rows(docs, none):
    out = simhash.near_duplicates(docs).collect()
    assert len(out) == len(TEXTS)
    found = {r["doc_id"]: r for r in out}
    assert found[3]["fp"] == found[4]["fp"] == found[5]["fp"] == 0
    assert {found[i]["component_id"] for i in (3, 4, 5)} == {3}
    assert found[10]["component_id"] == 9 and found[2]["component_id"] == 1
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("limit", [4096, 40])
def test_links_connect_what_brute_force_connects(spark, limit):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    walk = [np.uint64(7)]
    for _ in range(150):
        walk.append(walk[-1] ^ np.uint64(1 << int(rng.integers(0, 64))))
    flips = [b ^ np.uint64(sum(1 << int(i) for i in rng.choice(64, k, replace=False)))
             for b in base for k in (2, 4)]
    fps = np.unique(np.concatenate([base, flips, walk]).astype(np.uint64))
    nodes = settle(spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long"), "n")
    got = {r["node"]: r["root"] for r in
           simhash.components(simhash.links(nodes, 3, limit)).collect()}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(fps[i] ^ fps) <= 3):
            parent[find(i)] = find(int(j))
    signed = fps.view(np.int64)
    want, mine = {}, {}
    for i in range(len(fps)):
        want.setdefault(find(i), set()).add(int(signed[i]))
        mine.setdefault(got.get(int(signed[i]), int(signed[i])), set()).add(int(signed[i]))
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, mine.values()))


def test_bpe_equals_the_library(docs, none):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.byte_bpe())
    out = bpe.encode(docs, bpe.byte_bpe())
    texts = {i: t or "" for i, t, *_ in TEXTS}
    for row in out.withColumn("back", bpe.decoder(docs.sparkSession, bpe.byte_bpe())("ids")).collect():
        want = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == want
        assert row["back"] == library.decode(want, skip_special_tokens=False)
    for row in bpe.digests(docs, bpe.byte_bpe()).join(docs, "doc_id").collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.digests(none, bpe.byte_bpe()).count() == 0


def test_sketches(docs, none):
    unique = docs.dropDuplicates(["doc_id"])
    out = sketches.drift(unique).collect()
    order = sorted({(i if i is not None else sketches.LEAST_ID, t or "") for i, t, *_ in TEXTS})
    following = {i: order[(n + 1) % len(order)][1] for n, (i, _) in enumerate(order)}
    texts = dict(order)
    assert len(out) == len(order)
    for row in out:
        i = row["doc_id"] if row["doc_id"] is not None else sketches.LEAST_ID
        edited = sketches.edit(texts[i], following[i])
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == sketches.written(sketches.sketch(texts[i]))
        assert row["near_next"] == sketches.likeness(
            sketches.sketch(texts[i]), sketches.sketch(following[i]))
    assert sketches.drift(docs).count() == len(TEXTS) and sketches.drift(none).count() == 0
    a, b = "one two three four five six", " ".join(map(str, range(400)))
    both = sketches.merge(sketches.sketch(a), sketches.sketch(b))
    assert sketches.containment(sketches.sketch(b), both) == 1.0


def shingles(text, width=sketches.WIDTH):
    return {text[i:i + width] for i in range(max(1, len(text) - width + 1))}


def test_sketch_keeps_what_lies_below_the_limit():
    """Against hashes computed one by one, in pieces too, and back from its text."""
    def slow(run):
        value = 0
        for c in run:
            value = (value * sketches.BASE + ord(c) + 1) % 2 ** 64
        return int(sketches.mixed(np.array([value], np.uint64))[0])

    for text in ("a", "short", "ä𝄞 long enough to have more than one shingle " * 9):
        hashes = {slow(s) for s in shingles(text)}
        for limit in (sketches.LIMIT, (1 << 40) - 1, 0):
            want = sorted(h for h in hashes if h <= limit) or [min(hashes)]
            assert sketches.sketch(text, limit=limit).tolist() == want
        whole = sketches.sketch(text, limit=(1 << 40) - 1)
        assert sketches.parsed(sketches.written(whole)).tolist() == whole.tolist()
    assert sketches.written(sketches.sketch("")) == ""
    for width in (1, 2, 3, 7, 24):
        points = np.arange(40, dtype=np.uint64)
        assert len(sketches.rolled(points, width)) == 41 - width


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = "".join(chr(97 + i * i % 26) + str(i) for i in range(3000))
    whole = sketches.sketch(text).tolist()
    monkeypatch.setattr(sketches, "PIECE", 100)
    assert sketches.sketch(text).tolist() == whole


@pytest.mark.parametrize("length,error", [(300, 0.25), (3_000, 0.08), (30_000, 0.03)])
def test_containment_is_estimated_without_bias(length, error):
    """A text and its edited form, against exact shingle sets, short and long."""
    draw = np.random.default_rng(length)
    off, bare = [], 0
    for _ in range(60):
        text, other = ("".join(draw.choice(list("abcdefghij "), length)) for _ in range(2))
        edited = sketches.edit(text, other)
        a, b = sketches.sketch(text), sketches.sketch(edited)
        exact = len(shingles(text) & shingles(edited)) / min(len(shingles(text)), len(shingles(edited)))
        off.append(sketches.likeness(a, b) - exact)
        bare += len(a) == 1
        assert sketches.likeness(a, sketches.sketch(other)) < 0.5 or len(a) < 4
        assert len(sketches.written(a)) < len(text)
    assert abs(np.mean(off)) < error / 4 and np.sqrt(np.mean(np.square(off))) < error and bare < 3


def test_what_a_sketch_cannot_tell():
    below = sketches.sketch("many different characters 0123456789 " * 40)
    above = next(s for s in (sketches.sketch(f"t{i}") for i in range(99)) if s.min() > sketches.LIMIT)
    assert math.isnan(sketches.containment(above, below)) and sketches.likeness(above, below) == 0.0
    assert sketches.likeness(above, above) == 1.0


def test_mixing(spark, docs, none):
    out = mixing.mix(docs, group=2).collect()
    assert len(out) == len(TEXTS) and all(r["taken"] <= 2 * r["size"] for r in out)
    assert sorted(map(str, mixing.mix(docs, group=2).collect())) == sorted(map(str, out))
    many = rows_of(spark, [(i, "w " * (i % 50 + 1), "en", f"s{i % 3 % 2}") for i in range(600)])
    taken, aim = {}, {}
    for r in mixing.mix(many, group=16).collect():
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["taken"]
        aim[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - aim[s]) <= 20 for s in aim), (taken, aim)
    assert mixing.mix(none).count() == 0


def rounded(sizes, chance, seed, times=400):
    draw = np.random.default_rng(seed)
    sizes = np.sort(np.array(sizes))[::-1]
    drawn = np.array([mixing.pivot(sizes, np.full(len(sizes), chance), draw.random(len(sizes)), True)
                      for _ in range(times)])
    assert set(np.unique(drawn)) <= {0.0, 1.0}
    return drawn.mean(axis=0), np.abs(drawn @ sizes - chance * sizes.sum())


def lacking(large, rest, chance):
    """Words that the rest cannot make up for, on average, when a large document is drawn.

    What it gives in one outcome and takes in the other keeps its expected words, so the
    outcome in which it can do less decides.
    """
    able = rest / large * min(chance / (1 - chance), (1 - chance) / chance)
    return 2 * chance * (1 - chance) * large * max(0, 1 - able)


@pytest.mark.parametrize("chance", [0.1, 0.43, 0.8])
def test_pivot_keeps_chances_and_words(chance):
    """Every document keeps its chance; a large one is made up for by the small ones."""
    draw = np.random.default_rng(7)
    sizes = [5000, *draw.integers(1, 900, 60).tolist(), 1, 2, 3, 4, 5]
    taken, off = rounded(sizes, chance, 1)
    assert np.abs(taken - chance).max() < 0.12
    assert off.mean() <= lacking(5000, sum(sizes[1:]), chance) + 100
    # What the rest has not, it cannot make up for: at best the words of the large one less theirs.
    taken, off = rounded([1000, 100, 90, 80], chance, 2)
    assert off.mean() <= lacking(1000, 270, chance) + 50
    # The best that small sources can do, by trying all choices, is not far below what is done.
    for seed in range(5):
        few = np.random.default_rng(seed).integers(1, 60, 12)
        best = min(abs(few[[bool(m >> i & 1) for i in range(12)]].sum() - chance * few.sum())
                   for m in range(1 << 12))
        assert rounded(few, chance, seed)[1].mean() <= best + few.max() / 2


def test_targets_reshare_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 1000)],
                                  "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    total, left, want = 1665.0, {"a": 5, "b": 2, None: 1}, {}
    limits = {"a": 20, "b": 200, None: 2000}
    while True:
        level = (total - sum(want.values())) / sum(left.values())
        over = [s for s, w in left.items() if w * level > limits[s]]
        if not over:
            break
        for s in over:
            want[s] = limits[s]
            del left[s]
    want |= {s: w * level for s, w in left.items()}
    assert got == pytest.approx(want)


def test_rollup(spark, tmp_path, docs):
    rollup = rollups.Rollup(spark, f"file://{tmp_path}/r")
    schema = "doc_id long, version string, source string, lang string, tokens long, seq int"

    def batch(*rows):
        return spark.createDataFrame(list(rows), schema)
    assert rollup.totals().count() == 0
    first = batch((1, "v", "a", "en", 5, 0), (2, "v", "a", None, 7, 0), (None, "v", "a", "en", 1, 0))
    assert rollup.commit("one", first) and not rollup.commit("one", first)
    rollup.commit("two", batch((1, "v", "b", "en", 9, 1), (1, "v", "b", "en", 8, 0),
                               (2, "v", "a", None, None, 0), (3, "v", "a", "en", None, 0)))
    rollup.commit("none", batch())
    assert sorted(tuple(map(str, r)) for r in rollup.totals().collect()) == [
        ("a", "en", "v", "1", "1"), ("b", "en", "v", "1", "9")]


def test_warc_round_trip(spark, tmp_path):
    big = "<p>é</p>" * 300
    pages = [(1, "http://a.example/x y", big), (2, "https://B.example:8443/?q=1", big),
             (3, None, None), (None, "http://a.example/x y", "z"), (4, "::bad\r\nurl", "\r\n\r\nz"),
             (2, "https://B.example:8443/?q=1", big)]
    df = session(spark).createDataFrame(pages, "page_id long, url string, html string")
    archive = warc.write(warc.payloads(df), f"file://{tmp_path}/w", shard_lines=2)
    got = warc.read(archive, warc.lookup(archive, warc.keys_of(df))).collect()
    assert sorted((str(r["page_id"]), r["kind"], str(r["refers_to"])) for r in got) == sorted([
        ("1", "revisit", "2"), ("2", "response", "None"), ("2", "response", "None"),
        ("3", "response", "None"), ("None", "response", "None"), ("4", "response", "None")])
    want = {i: (h or "").encode() for i, _, h in pages}
    assert all(bytes(r["payload"]) == want[r["page_id"]] for r in got if r["kind"] == "response")
    missing = spark.createDataFrame([("com,none)/ 1",)], "key string")
    assert warc.lookup(archive, missing).count() == 0
    empty = warc.write(warc.payloads(df.limit(0)), f"file://{tmp_path}/e")
    assert warc.lookup(empty, missing).count() == 0


def test_language(spark, docs, none):
    words = {"en": "the house is on the hill and the sun is high ", "de": "das haus steht auf dem berg und die sonne scheint "}
    train = rows_of(spark, [(i, w * 3, k, "s") for k, w in words.items() for i in range(5)])
    trees = language.learn(train)
    out = {r["doc_id"]: r for r in language.identify(docs, trees).collect()}
    assert out[3]["lang_pred"] == out[4]["lang_pred"] == out[5]["lang_pred"] == "und"
    assert trees.predict("the sun and the house")[0] == "en"
    assert trees.predict("und das haus auf dem berg")[0] == "de"
    # Code lengths against a plain walk through the counts.
    counts = {}
    for w in [words["en"] * 3] * 5:
        padded = language.START + w.encode()
        for i in range(4, len(padded)):
            counts[padded[i - 4:i + 1]] = counts.get(padded[i - 4:i + 1], 0) + 1
    text, bits = b"the hat\xff", 0.0
    padded = language.START + text
    for i in range(4, len(padded)):
        for m in range(4, -1, -1):
            seen = {}
            for gram, n in counts.items():
                if gram[4 - m:4] == padded[i - m:i]:
                    seen[gram[4]] = seen.get(gram[4], 0) + n
            total, kinds = sum(seen.values()), len(seen)
            if padded[i] in seen:
                bits += math.log2((total + kinds) / seen[padded[i]])
                break
            bits += math.log2((total + kinds) / kinds) if kinds else 0
        else:
            bits += 8
    assert trees.code_length(text)[trees.languages.index("en")] == pytest.approx(bits, rel=1e-5)
    assert language.learn(none).predict("abc") == ("und", 0.0)


def test_language_keeps_what_occurs_once(spark):
    texts = {"en": "the quick brown fox", "fi": "älä syö yksin", "pl": "dzień"}
    many = [(i, "the house is on the hill " * 3, "en", "s") for i in range(10, 20)]
    rows = [(i, t, k, "s") for i, (k, t) in enumerate(texts.items())]
    trees = language.learn(rows_of(spark, many + rows + [(50, "", "xx", "s")]))
    assert trees.languages == ["en", "fi", "pl"]
    assert trees.predict("syö yksin")[0] == "fi" and trees.predict("dzień")[0] == "pl"
    # Code length in the text of a single document, by its definition.
    padded, text, bits = language.START + texts["fi"].encode(), "yksi älä z".encode(), 0.0
    asked = language.START + text
    for i in range(4, len(asked)):
        for m in range(4, -1, -1):
            after = [padded[j] for j in range(4, len(padded)) if padded[j - m:j] == asked[i - m:i]]
            kinds = len(set(after))
            if asked[i] in after:
                bits += math.log2((len(after) + kinds) / after.count(asked[i]))
                break
            bits += math.log2((len(after) + kinds) / kinds) if kinds else 0
        else:
            bits += 8
    assert trees.code_length(text)[1] == pytest.approx(bits, rel=1e-5)


def test_any_number_of_languages(spark):
    """More than 256 names, in blocks; the sample ends by documents or by bytes."""
    rows = [(i, f"kieli{i:03d} sana{i:03d} lause{i:03d} " * 2, f"x{i:03d}", "s") for i in range(300)]
    forest = language.learn(rows_of(spark, rows), block=64)
    assert len(forest.blocks) == 5 and len(forest.languages) == 300
    assert all(forest.predict(t)[0] == lang for _, t, lang, _ in rows[::37])
    few = rows_of(spark, rows[:20])
    alone, together = (language.learn(few, block=b).code_length(b"lause007") for b in (1, 20))
    assert alone == pytest.approx(together, rel=1e-6)
    many = [(i, "x" * 100, "en", "s") for i in range(50)] + [(7, "y" * 100, "en", "s")] * 3
    named = rows_of(spark, many).select(F.col("doc_id").alias("id"), "lang", "text")
    assert language.chosen(named, 10, 10 ** 9).count() == 10
    assert language.chosen(named, 1000, 550).count() == 6


def test_toxicity(spark, docs, none):
    texts = [(i, ("fine words here " + ("you idiot " if i % 3 == 0 else "dear friend ")) * 2,
              "en", "s") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(90)] + [(None, 1), (5000, 0)],
                                   "doc_id long, toxic int")
    model = toxicity.fit(rows_of(spark, texts), labels)
    assert model.score("here you idiot you idiot") > 0.5 > model.score("here dear friend")
    assert model.score(None) == model.score("") < 0.5
    assert toxicity.fit(none, labels).score("idiot") < 0.5
    none_toxic, all_toxic = (labels.withColumn("toxic", F.lit(v)) for v in (0, 1))
    assert toxicity.fit(rows_of(spark, texts), none_toxic).score("idiot") < 1e-9
    assert toxicity.fit(rows_of(spark, texts), all_toxic).score("") > 1 - 1e-9
    score = toxicity.scorer(spark, model)
    assert docs.select(score(F.col("text"))).count() == len(TEXTS)



def test_bpe_gives_back_what_it_remembers():
    from pitchlake.llm import bpe

    encoder = bpe.Encoder(bpe.Vocabulary({0: b"a", 1: b" ", 2: b" a"}, [(1, 0, 2)], {}))
    encoder.packed("a a a  a")
    assert encoder.chunks or encoder.pieces
    encoder.forget()
    assert not (encoder.chunks or encoder.pieces or encoder.chunks.older or encoder.pieces.older)
    assert all(isinstance(pair, int) for pair in encoder.breaks)
