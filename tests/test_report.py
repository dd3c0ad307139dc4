"""The report at size: keys by one aggregation, bounded tasks, joins without sorting."""

from collections import Counter

from pyspark.sql import functions as F

from catalog import league
from pitchlake.operators import quality
from pitchlake.operators.contract import Contract, ForeignKey
from pitchlake.functions.text import to_int
from pitchlake.operators.watch import Cells, Watch
from pitchlake.plans import base
from pitchlake.session import HASH_JOIN_LIMIT, hash_joins

GAMES = [(1, "a"), (2, "b"), (2, "c"), (None, "d"), (4, None)]
PLAYS = [(1, 1, "1"), (1, 7, "7"), (2, 7, "08"), (2, None, "2"), (None, 9, None), (9, 4, "8")]


def brute(child, parent):
    lost = Counter(v for v in child if v is not None and v not in set(parent))
    return sum(lost.values()), len(lost)


def test_keys_are_counted_by_one_aggregation_each(spark, tmp_path):
    games = spark.createDataFrame(GAMES, "game int, name string")
    plays = spark.createDataFrame(PLAYS, "game bigint, other smallint, text string")
    tables = {"games": games, "plays": plays}
    links = [Contract("plays", (), (), (
        ForeignKey(("game",), "games", ("game",)), ForeignKey(("other",), "games", ("game",)),
        ForeignKey(("text",), "games", ("name",)), ForeignKey(("game", "text"), "games", ("game", "name")),
        ForeignKey(("game",), "absent", ("game",)), ForeignKey(("other",), "plays", ("text",))))]
    unique = {"games": [["game"], ["game", "name"]], "plays": [["game", "other"], ["game"]], "absent": [["x"]]}
    index = quality.key_index(tables, unique, links, str(tmp_path / "keys"))
    # One row for every key and link, however many values they have.
    assert index.count() == 4 + 5

    found = {(r.table, r.column): r.failures for r in
             quality.index_unique(index, unique, tables).collect()}
    assert found == {("games", "game"): 1, ("games", "game,name"): 0,
                     ("plays", "game,other"): 0, ("plays", "game"): 2}

    known = [g for g, _ in GAMES]
    pairs = [(g, x) if g is not None and x is not None else None for g, _, x in PLAYS]
    wanted = {
        ("game", "games: game"): brute([p[0] for p in PLAYS], known),
        ("other", "games: game"): brute([p[1] for p in PLAYS], known),
        ("text", "games: name"): brute([p[2] for p in PLAYS], [n for _, n in GAMES]),
        ("game,text", "games: game,name"): brute(pairs, GAMES),
        # Numbers compare with text as text.
        ("other", "plays: text"): brute([p[1] and str(p[1]) for p in PLAYS], [p[2] for p in PLAYS])}
    rows = quality.index_foreign_keys(index, tables, links).collect()
    assert sorted((r.column, r.failures, r.detail) for r in rows) == sorted(
        (column, failures, f"{target.split(':')[0]}: {keys} keys")
        for (column, target), (failures, keys) in wanted.items())

    plan = quality.key_findings(tables, "games", ["game"], True, [("plays", ["game"])])
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_made_in_tasks_of_bounded_size(spark):
    rows = spark.range(5 * league.LARGE_TASK + 1)
    lines = league._snapshots(rows, F.array(F.lit(2020)), id=F.col("id"))
    assert lines.rdd.getNumPartitions() == 6
    few = league._snapshots(spark.range(3), F.array(F.lit(2020), F.lit(2021)), id=F.col("id"))
    assert few.rdd.getNumPartitions() == 1
    assert few.count() == 6
    assert league._spread(spark.range(0)).count() == 0


def test_joins_of_a_build_need_no_sort(spark):
    def joined():
        left, right = (spark.range(2000).select((F.col("id") % n).alias("k")) for n in (7, 900))
        both = left.join(right, "k")
        both.collect()
        return both._jdf.queryExecution().executedPlan().toString(), both.count()

    limit, before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get(HASH_JOIN_LIMIT)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sorted_plan, rows = joined()
        with hash_joins(spark):
            plan, same = joined()
        assert "SortMergeJoin" in sorted_plan
        assert "ShuffledHashJoin" in plan.split("Initial Plan")[0]
        assert rows == same
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert spark.conf.get(HASH_JOIN_LIMIT) == before


def test_entries_of_a_line_up_are_distinct_by_club_and_list(spark):
    side = "struct<href: string, formation: string, starting_lineup: array<string>, substitutes: array<string>>"

    def player(number, extra=""):
        return f'{{"number":"{number}","href":"/p/profil/spieler/{number}"{extra}}}'

    def club(id_, first, rest):
        return (f"/c/startseite/verein/{id_}" if id_ else None, None, first, rest)

    one, other = player(1), player(1, ',"unread":1')
    records = [
        # The same club on both sides, no club on both sides, two clubs, a missing side.
        (1, club(5, [one, one, None], [one]), club(5, [one, other, None], [one, player(2)])),
        (2, club(None, [one], None), club(None, [one], [])),
        (3, club(5, [one, one], None), club(6, [one], [one])),
        (4, None, club(6, None, [one, other, one, None, None]))]
    rows = spark.createDataFrame(records, f"game_id int, home_club {side}, away_club {side}")
    wanted = Counter()
    for game, *sides in records:
        entries = {(s[0] and int(s[0].rsplit("/", 1)[1]), kind, p)
                   for s in sides if s for kind, players in zip(("starting_lineup", "substitutes"), s[2:])
                   for p in players or []}
        wanted.update((game, c, kind, p and int(p.split('"')[3])) for c, kind, p in entries)
    got = Counter((r.game_id, r.club_id, r.type, r.player_id) for r in base.game_lineups(rows).collect())
    assert got == wanted


def test_cells_are_read_once_and_counted_before_their_default(spark):
    rows = spark.createDataFrame([("1", "x"), ("many", "-"), (None, "2"), (" ", "3"), ("null", None)],
                                 "a string, b string")
    watch = Watch()
    cell = Cells("t", watch)
    table = cell.select(rows, cell("a", F.col("a"), to_int, -1), cell("n", F.col("b"), to_int), "b")
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(b") == Cells("t", None).select(rows, to_int(F.col("b")))._jdf.queryExecution(
        ).optimizedPlan().toString().count("try_cast(b")
    assert table.columns == ["a", "n", "b"]
    assert [tuple(r) for r in table.collect()] == [
        (1, None, "x"), (-1, None, "-"), (-1, 2, "2"), (-1, 3, "3"), (-1, None, None)]
    assert watch.rows() == [("unreadable_cell", "t", "a", 1), ("unreadable_cell", "t", "n", 1)]
    unwatched = Cells("t", None)
    assert unwatched.select(rows, unwatched("a", F.col("a"), to_int, -1)).agg(F.sum("a")).first()[0] == -3
