"""Operators against brute force and on their edge cases."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import analyst, contract, gate, merge, quality, reshape, snapshot
from pitchlake.operators.asof import DATE_GRAINS, TIMESTAMP_GRAINS, asof_join
from pitchlake.plans import refresh
from pitchlake.sinks.releases import Releases
from pitchlake.sources import snapshots
from pitchlake.streaming import arrivals


def brute_asof(left, right):
    out = {}
    for i, k, t in left:
        known = [(s, n, v) for n, rk, s, v in right if rk == k and k is not None and s <= t]
        out[i] = max(known, key=lambda x: x[:2])[1:] if known else (None, None)
    return out


@pytest.mark.parametrize("seed", range(2))
def test_asof_join_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    start = datetime(2024, 1, 30, 23, 50)

    def moment():
        return start + timedelta(seconds=rng.choice([0, 1, 59, 60, 61, rng.randrange(200000)]))

    # One key holds most rows, some keys are missing, moments repeat.
    keys = [1] * 6 + [2, 3, None]
    left = [(i, rng.choice(keys), moment()) for i in range(120)]
    right = [(i, rng.choice(keys), moment(), rng.choice([None, i])) for i in range(80)]
    lf = spark.createDataFrame(left, "i int, k int, t timestamp")
    rf = spark.createDataFrame(right, "n int, k int, s timestamp, v int")
    got = asof_join(lf, rf, "k", "t", "s", ["n", "v"], [F.col("n")], TIMESTAMP_GRAINS)
    assert {r.i: (r.n, r.v) for r in got.collect()} == brute_asof(left, right)


def test_asof_join_by_date_over_years(spark):
    left = [(i, 1, date(2010 + i, 6, 1)) for i in range(12)]
    right = [(1, 1, date(2012, 6, 1), 5), (2, 1, date(2016, 1, 1), None)]
    lf = spark.createDataFrame(left, "i int, k int, t date")
    rf = spark.createDataFrame(right, "n int, k int, s date, v int")
    for grains in (DATE_GRAINS, ()):
        got = asof_join(lf, rf, "k", "t", "s", ["n", "v"], [F.col("n")], grains)
        assert {r.i: (r.n, r.v) for r in got.collect()} == brute_asof(left, right)


def test_latest_is_idempotent_and_keeps_whole_rows(spark):
    df = spark.createDataFrame([(1, 2020, "a"), (1, 2021, None), (2, 2019, "c"), (None, 1, "d")],
                               "k int, season int, v string")
    once = snapshot.latest(df, ["k"], F.desc("season"))
    assert sorted(map(tuple, once.collect()), key=str) == [
        (1, 2021, None), (2, 2019, "c"), (None, 1, "d")]
    twice = snapshot.latest(once, ["k"], F.desc("season"))
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_unusable_snapshot_does_not_hide_an_older_one(spark):
    df = spark.createDataFrame([(1, 2020, "f", 1, "a"), (1, 2021, "f", 2, None)],
                               "k int, season int, filename string, line_hash long, v string")
    kept = snapshot.newest_usable(df, ["k"], F.col("v").isNotNull())
    assert kept.first().season == 2020


def test_two_sided_is_self_inverse(spark):
    df = spark.createDataFrame([(1, 10, 20, 2, 1), (2, 30, 10, None, 3)],
                               "g int, h int, a int, hg int, ag int")
    both = reshape.two_sided(df, ["g"], {"id": ("h", "a"), "goals": ("hg", "ag")},
                             {"id": ("own", "opp"), "goals": ("og", "pg")}, "side", ("Home", "Away"))
    rows = {(r.g, r.side): (r.own, r.opp, r.og, r.pg) for r in both.collect()}
    assert len(rows) == 4
    for g in (1, 2):
        own, opp, og, pg = rows[g, "Home"]
        assert rows[g, "Away"] == (opp, own, pg, og)


def test_explode_json_skips_missing_and_empty(spark):
    df = spark.createDataFrame([(1, "[{\"a\":1},2]"), (2, "[]"), (3, None)], "i int, j string")
    assert [(r.i, r.x) for r in reshape.explode_json(df, F.col("j"), "x").collect()] == [
        (1, "{\"a\":1}"), (1, "2")]


def test_upsert_keeps_every_key_once_and_all_new_rows(spark):
    old = spark.createDataFrame([(1, "o1"), (2, "o2")], "k int, v string")
    new = spark.createDataFrame([(2, "n2", 9), (3, "n3", 8)], "k int, v string, extra int")
    rows = {r.k: (r.v, r.extra) for r in merge.upsert(new, old, ["k"]).collect()}
    assert rows == {1: ("o1", None), 2: ("n2", 9), 3: ("n3", 8)}
    assert merge.upsert(new, None, ["k"]) is new


def test_merge_snapshot_with_drifting_types(spark, tmp_path):
    (tmp_path / "old.json").write_text(
        '{"href":"/a/1","coach_name":null,"parent":{"href":"/l/X","coach":null}}\n'
        '{"href":"/a/2","coach_name":null,"parent":{"href":"/l/X","coach":null}}\n')
    (tmp_path / "new.json").write_text(
        '{"href":"/a/2","coach_name":"C","parent":{"href":"/l/Y","coach":"D"},"extra":1}\n')
    for target, old in (("t1", str(tmp_path / "old.json")), ("t2", None)):
        refresh.merge_snapshot(spark, str(tmp_path / "new.json"), old, "clubs",
                               str(tmp_path / target))
    rows = {r.href: r for r in spark.read.json(str(tmp_path / "t1")).collect()}
    assert set(rows) == {"/a/1", "/a/2"}
    assert rows["/a/2"].coach_name == "C" and rows["/a/2"].extra == 1
    assert "/l/X" in rows["/a/1"].parent
    assert spark.read.json(str(tmp_path / "t2")).count() == 1


def responses(spark, total, nulls):
    return spark.createDataFrame([(i, None if i < nulls else "x") for i in range(total)],
                                 "player_id int, response string")


@pytest.mark.parametrize("total,nulls,accepted", [
    (100, 0, True), (100, 1, True), (100, 20, True), (100, 21, False), (100, 50, False),
    (100, 100, False), (0, 0, False)])
def test_gate(spark, total, nulls, accepted):
    df = responses(spark, total, nulls)
    assert gate.gate_verdict(df, F.col("response").isNull()).first().accepted is accepted
    if accepted:
        gate.check(df, F.col("response").isNull(), "x")
    else:
        with pytest.raises(gate.RefusedWrite):
            gate.check(df, F.col("response").isNull(), "x")


def stored(spark, store):
    schema = "player_id int, response string"
    return {name: sorted(r.player_id for r in spark.read.schema(schema).json(path).collect())
            for name, path in store.current().items()}


def test_nothing_is_written_when_one_output_is_poor(spark, tmp_path):
    good, poor = responses(spark, 10, 0), responses(spark, 10, 9)
    wanted, store = good.select("player_id"), Releases(spark, str(tmp_path / "store"))
    with pytest.raises(gate.RefusedWrite):
        refresh.store_responses(good, poor, wanted, store)
    assert store.current() == {}
    extra = spark.createDataFrame([(99, "x")], "player_id int, response string")
    refresh.store_responses(good, good.union(extra), wanted, store)
    assert stored(spark, store) == {"market_values.json": list(range(10)),
                                    "transfers.json": list(range(10))}


def test_a_failure_between_two_outputs_leaves_both_old_ones(spark, tmp_path, monkeypatch):
    store = Releases(spark, str(tmp_path / "store"))
    missing = F.col("response").isNull()
    old = {"a": responses(spark, 3, 0), "b": responses(spark, 4, 0)}
    gate.guarded_write(store, old, missing)
    before = stored(spark, store)
    broken = responses(spark, 5, 0).withColumn("response", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        gate.guarded_write(store, {"a": responses(spark, 9, 0), "b": broken}, missing)
    assert stored(spark, store) == before
    # Everything is written, and the commit itself fails.
    monkeypatch.setattr(Releases, "commit", lambda *a, **b: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        gate.guarded_write(store, {n: responses(spark, 9, 0) for n in old}, missing)
    monkeypatch.undo()
    assert stored(spark, store) == before and store.number() == 1
    gate.guarded_write(store, {"b": responses(spark, 6, 0)}, missing, tag="later")
    assert stored(spark, store) == {**before, "b": list(range(6))}
    assert store.has("later") and not store.has("other") and store.current(1) != store.current()


def test_guarded_write_may_replace_its_own_input(spark, tmp_path):
    store = Releases(spark, str(tmp_path / "store"))
    missing = F.col("response").isNull()
    gate.guarded_write(store, {"values": responses(spark, 10, 0)}, missing)
    kept = spark.read.json(store.current()["values"]).filter("player_id > 3")
    gate.guarded_write(store, {"values": kept}, missing)
    assert stored(spark, store) == {"values": [4, 5, 6, 7, 8, 9]}


def test_merge_survives_drift_at_any_depth(spark, tmp_path):
    (tmp_path / "old.json").write_text("\n".join([
        '{"href":"/p/1","height":185,"box":{"deep":{"x":1},"same":"a"},"list":[1,2],"gone":true}',
        '{"href":"/p/2","height":1.5,"box":{"deep":{"x":2},"same":"b"},"list":[],"none":null}']))
    (tmp_path / "new.json").write_text("\n".join([
        '{"href":"/p/2","height":"1,85 m","box":{"deep":"flat","more":7},"list":"one"}',
        '{"href":"/p/3","height":null,"odd name":{"a`b":[{"c":1}]}}', '{"href": broken', '[3]']))
    new, old, target = (str(tmp_path / n) for n in ("new.json", "old.json", "out.json"))
    with pytest.raises(ValueError, match="2 lines"):
        refresh.merge_snapshot(spark, new, old, "countries", target)
    refresh.merge_snapshot(spark, new, old, "countries", target, str(tmp_path / "lost"))
    schema = ("href string, height string, box struct<deep: string, same: string, more: long>, list string,"
              "gone boolean, `odd name` struct<`a``b`: array<struct<c: long>>>")
    rows = {r.href: r for r in spark.read.schema(schema).json(target).collect()}
    assert [rows[f"/p/{i}"].height for i in (1, 2, 3)] == ["185", "1,85 m", None]
    assert rows["/p/1"].box == ('{"x":1}', "a", None) and rows["/p/2"].box == ("flat", None, 7)
    assert rows["/p/1"]["list"] == "[1,2]" and rows["/p/2"]["list"] == "one" and rows["/p/1"].gone
    assert rows["/p/3"]["odd name"][0][0].c == 1
    assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "lost")).collect()) == [
        "[3]", '{"href": broken']


def test_records_with_nothing_to_unite(spark, tmp_path):
    (tmp_path / "a.json").write_text('{}\n{"x":{}}\n')
    (tmp_path / "b.json").write_text("not json\n")
    got = snapshots.read_records(spark, str(tmp_path / "a.json"))
    assert sorted(map(tuple, got.collect()), key=str) == [("{}",), (None,)]
    with pytest.raises(ValueError, match="1 lines"):
        snapshots.read_records(spark, str(tmp_path / "b.json"))


def test_season_of_files_and_folders_of_parts(spark):
    paths = {"/r/2024/games.json.gz": 2024, "/r/season=2023/x.json": 2023, "/r/plain/x.json": None,
             "/r/2024/plain/x.json": None, "/r/2022/values.json/part-0.json": 2022,
             "/r/2021/values.json/version-0a9/part-0.json": 2021, "/r/week=3/part-1.txt.gz": 3}
    df = spark.createDataFrame(list(paths.items()), "path string, want int")
    got = df.withColumn("season", snapshots.season_of(F.col("path"))).collect()
    assert all(r.season == r.want for r in got), got


def test_arrivals_are_merged_once(spark, tmp_path):
    inbox, store, seen = (tmp_path / n for n in ("in", "store", "seen"))

    def put(season, name, *lines):
        (inbox / season).mkdir(parents=True, exist_ok=True)
        (inbox / season / name).write_text("\n".join(lines))

    def follow():
        return arrivals.follow(spark, f"{inbox}/*", "players", str(store), str(seen))

    def lines():
        rows = arrivals.stored_lines(spark, str(store), "players").collect()
        return sorted((r.season, r.value) for r in rows)

    put("2023", "a.json", '{"href":"/p/1","v":1}', '{"href":"/p/2","v":1}', "", "no key")
    put("2024", "a.json", '{"href":"/p/1","v":"two"}')
    assert follow() == 1
    first = lines()
    assert first == [(2023, "no key"), (2023, '{"href":"/p/1","v":1}'), (2023, '{"href":"/p/2","v":1}'),
                     (2024, '{"href":"/p/1","v":"two"}')]
    assert follow() == 1 and lines() == first
    put("2023", "b.json", '{"href":"/p/2","v":[2]}', '{"href":"/p/3","v":3}', "no key")
    # The stream forgets that it has finished its last batch, and runs it again.
    for mark in (seen / "commits").glob("*0*"):
        mark.unlink()
    assert follow() == 2
    assert lines() == [(2023, "no key"), (2023, '{"href":"/p/1","v":1}'), (2023, '{"href":"/p/2","v":[2]}'),
                       (2023, '{"href":"/p/3","v":3}'), (2024, '{"href":"/p/1","v":"two"}')]


def test_diff_of_many_copies_is_a_few_runs(spark):
    many = spark.range(300_000).select(F.lit(None).cast("string").alias("k"), F.lit("a").alias("v"))
    few = spark.createDataFrame([(None, "b"), (None, "c"), ("x", "z")], "k string, v string")
    got = sorted(map(tuple, analyst.table_diff(many, few, ["k"]).collect()))
    assert got == [("added", "*", 1), ("changed", "v", 2), ("removed", "*", 299_998)]
    runs = spark.createDataFrame([(None, "a", 300_000, False), (None, "b", 70_000, True)],
                                 "k string, v string, __n long, __new boolean")
    pairs = analyst._overlaps(runs, ["k"], ["v"]).collect()
    assert sum(r["__n"] for r in pairs if r["__a"] and r["__b"]) == 70_000
    assert sum(r["__n"] for r in pairs) == 300_000 and len(pairs) < 10


def test_round_robin_counts_without_expanding(spark):
    games = spark.createDataFrame([(1, 2020, i, i % 3) for i in range(6)] + [(1, 2021, 9, 0), (1, 2022, 10, 1)],
                                  "league int, season int, game int, club int")
    counts = quality.distinct_ids(games, ["league", "season"], {"games": "game", "clubs": "club"})
    assert "Expand" not in counts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, counts.collect())) == [(1, 2020, 6, 3), (1, 2021, 1, 1), (1, 2022, 1, 1)]
    found = quality.incomplete_round_robin(games, "league", "season", "game", "club").collect()
    assert [(r.season, r.actual_games, r.expected_games) for r in found] == [(2021, 1, 0)]


def test_retries_fill_only_what_is_missing(spark):
    first = spark.createDataFrame([(1, "a"), (2, None), (3, None)], "player_id int, response string")
    again = spark.createDataFrame([(1, "z"), (2, "b")], "player_id int, response string")
    last = spark.createDataFrame([(2, "y"), (3, "c")], "player_id int, response string")
    got = refresh.with_retries(first, [again, last])
    assert {r.player_id: r.response for r in got.collect()} == {1: "a", 2: "b", 3: "c"}


def test_supplement(spark):
    found = spark.createDataFrame([("A", 1), ("B", 1)], "id string, n int")
    extra = spark.createDataFrame([("B", 2), ("C", 2), ("C", 3), ("D", 2)], "id string, n int")
    got = merge.supplement(found, extra, "id", ["A", "B", "C"], [F.asc("n")])
    assert sorted(map(tuple, got.collect())) == [("A", 1), ("B", 1), ("C", 2)]


def records(spark, rows):
    return spark.createDataFrame([(h, (p,)) for h, p in rows],
                                 "href string, parent struct<href: string>")


def test_scope_chain(spark):
    assets = {
        "competitions": records(spark, [("/c/L1", None), ("/c/L2", None)]),
        "clubs": records(spark, [("/v/1", "/c/L1"), ("/v/2", "/c/L2")]),
        "players": records(spark, [("/p/10", "/v/1"), ("/p/20", "/v/2")]),
        "appearances": records(spark, [("/p/10", "/p/10"), ("/p/20", "/p/20")]),
        "games": records(spark, [("/g/100", "/c/L1"), ("/g/200", "/c/L2")]),
        "game_lineups": records(spark, [("/l/100", None), ("/l/200", None)]),
    }
    kept = merge.scope_chain(assets, competitions=["L1"])
    assert {n: [r.href for r in df.collect()] for n, df in kept.items()} == {
        "competitions": ["/c/L1"], "clubs": ["/v/1"], "players": ["/p/10"],
        "appearances": ["/p/10"], "games": ["/g/100"], "game_lineups": ["/l/100"]}
    kept = merge.scope_chain(assets, players=["20"])
    assert [r.href for r in kept["appearances"].collect()] == ["/p/20"]
    with pytest.raises(ValueError):
        merge.scope_chain(assets, clubs=["77"])
    ids = refresh.player_ids(assets["players"], assets["clubs"], competitions=["L2"])
    assert [r.player_id for r in ids.collect()] == [20]


def test_contract(spark):
    declared = contract.Contract("t", (contract.Field("a", "integer", tags=("explore",)),
                                       contract.Field("b", "unknown")))
    df = spark.sql("select 'x' as b, 1 as a")
    assert declared.project(df).columns == ["a", "b"]
    assert declared.tagged("explore") == ["a"]
    assert declared.schema["b"].dataType.typeName() == "string"
    with pytest.raises(contract.ContractError):
        declared.project(df.withColumn("c", F.lit(1)))
    with pytest.raises(contract.ContractError):
        declared.project(df.drop("a"))


def test_profile_and_filters(spark):
    df = spark.sql("""select * from values (1, 'b', date'2020-01-01'), (3, 'a', null), (2, 'b', null),
                      (4, null, null) as t(n, s, d)""")
    rows = {r.field: (r.type, r.description, r.sample_values)
            for r in analyst.profile(df, descriptions={"n": "number"}).collect()}
    assert rows == {"n": ("int", "number", "1, 2, 3"), "s": ("string", None, "a, b"),
                    "d": ("date", None, "2020-01-01")}
    assert analyst.default_filters(df, []) == df.columns
    assert analyst.preview(df, {"s": "b"}, [F.desc("n")], 1).first().n == 2


def test_records_delta(spark):
    df = spark.sql("select * from values (date'2024-01-01'), (date'2024-01-09'), (null) as t(date)")
    as_of = F.lit("2024-01-10").cast("date")
    assert tuple(analyst.records_delta(df, as_of).first()) == (3, 1)
    assert tuple(analyst.records_delta(df.withColumnRenamed("date", "d"), as_of).first()) == (3, None)


def test_table_diff(spark):
    old = spark.sql("select * from values (1, 'a', 1), (2, 'b', 2), (3, null, 3) as t(k, s, n)")
    new = spark.sql("select * from values (2, 'c', 9), (3, null, 3), (4, 'd', 4) as t(k, s, n)")
    rows = {(r.kind, r.column): r["rows"] for r in analyst.table_diff(old, new, ["k"]).collect()}
    assert rows == {("added", "*"): 1, ("removed", "*"): 1, ("changed", "s"): 1, ("changed", "n"): 1}


def test_table_diff_of_repeated_and_null_keys(spark):
    def diff(old, new):
        sides = [spark.createDataFrame(rows, "k int, s string, n int") for rows in (old, new)]
        return {(r.kind, r.column): r["rows"] for r in analyst.table_diff(*sides, ["k"]).collect()}

    assert diff([(1, "a", 1), (1, "a", 5)], [(1, "a", 2), (1, "a", 5)]) == {("changed", "n"): 1}
    hot = [(None, "a", i) for i in range(300)]
    moved = [(None, "b" if i < 200 else "a", i) for i in range(300)]
    assert diff(hot, moved)[("changed", "s")] == 200
    copies = [(None, "a", 1)] * 5 + [(2, None, None)] * 3
    assert diff(copies, copies[2:7]) == {("removed", "*"): 3}
    assert diff(copies, [(None, "b", 1)] * 4 + [(2, None, 7)] * 4) == {
        ("removed", "*"): 1, ("added", "*"): 1, ("changed", "s"): 4, ("changed", "n"): 3}


def test_rules_in_one_pass(spark):
    df = spark.sql("select * from values (1, 'a'), (null, 'b'), (9, null) as t(n, s)")
    rows = [(r.check, r.failures, r.detail) for r in quality.measure(df, "t", [
        quality.not_null("n"), quality.accepted_values("s", ["a"]),
        quality.values_not_in("s", ["b"]), quality.values_between("n", 2),
        quality.values_between("n", None, 5), quality.missing_share("s", 0.4),
        quality.missing_share("s", 0.3), quality.row_count_between(4, 5)]).collect()]
    assert rows == [("not_null", 1, None), ("accepted_values", 1, None), ("values_not_in", 1, None),
                    ("values_between", 1, None), ("values_between", 1, None),
                    ("missing_share", 0, "0.3333"), ("missing_share", 1, "0.3333"),
                    ("row_count", 1, "3")]


def test_missing_share_of_an_empty_table(spark):
    df = spark.createDataFrame([], "s string")
    assert quality.measure(df, "t", [quality.missing_share("s", 0.1)]).first().failures == 0


def test_composite_keys_do_not_collide(spark):
    df = spark.sql("select * from values ('1', '23'), ('12', '3'), ('1', '23') as t(a, b)")
    assert quality.duplicates(df, ["a", "b"]).count() == 1


def test_facts_of_games_with_an_unknown_side_are_not_reported(spark):
    games = spark.sql("select * from values (1, 10, 20), (2, 10, null) as t(g, h, a)")
    facts = spark.sql("select * from values (1, 10), (1, 99), (2, 99), (3, 99) as t(g, c)")
    bad = quality.outside_pair(facts, "c", games, "g", ("h", "a"))
    assert [tuple(r) for r in bad.collect()] == [(1, 99)]


def test_round_robin(spark):
    rows = [("L", 2020 + s, f"{s}{h}{a}", h) for s in range(3) for h in range(3) for a in range(3)
            if h != a]
    rows = [r for r in rows if r[2] != "101"]
    rows += [("X", 2020, "x1", 1)]
    games = spark.createDataFrame(rows, "l string, s int, g string, h int")
    bad = quality.incomplete_round_robin(games, "l", "s", "g", "h")
    assert [(r.l, r.s, r.actual_games, r.expected_games) for r in bad.collect()] == [("L", 2021, 5, 6)]
    assert quality.incomplete_round_robin(games, "l", "s", "g", "h", skip_groups=["L"]).isEmpty()
    assert quality.incomplete_round_robin(games, "l", "s", "g", "h",
                                          skip_pairs=[("L", 2021)]).isEmpty()


def test_single_entity_without_rows_fails(spark):
    df = spark.sql("select 1 as p, 2 as c")
    assert quality.short_history_of(df, "p", 7, "c", 2).count() == 1
    assert quality.short_history(df, "p", "c", 2).count() == 1


def test_supplement_takes_keys_as_a_table(spark):
    # As literals in one condition, so many keys do not fit a plan.
    found = spark.createDataFrame([("K1", "found"), ("X", "found"), (None, "found")], "id string, n string")
    extra = spark.createDataFrame([("K1", "hand"), ("K150000", "b"), ("K150000", "a"), ("Y", "hand")],
                                  "id string, n string")
    keys = spark.range(200_000).select(F.concat(F.lit("K"), F.col("id").cast("string")).alias("code"))
    got = merge.supplement(found, extra, "id", keys.union(keys), [F.asc("n")])
    assert sorted(map(tuple, got.collect())) == [("K1", "found"), ("K150000", "a")]
