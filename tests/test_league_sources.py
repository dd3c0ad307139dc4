"""Records that the league queries make of generated tables."""

from types import SimpleNamespace

from catalog import league
from pitchlake.plans import base


def _orders(spark, keys):
    return spark.createDataFrame([(k, 7) for k in keys], "o_orderkey long, o_custkey long").selectExpr(
        "*", "timestamp '2020-05-06 00:00:00' as o_orderdate")


def test_lists_of_games_are_made_without_interpreted_lambdas(spark):
    t = SimpleNamespace(orders=_orders(spark, [3]))
    plan = league.raw_game_lineups(t)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_events_of_games_with_any_key(spark):
    t = SimpleNamespace(orders=_orders(spark, [3, 4, 5, -3, -4, -5, None]))
    found = {r[0]: r[1] for r in league.raw_games(t).selectExpr(
        "get_json_object(value, '$.href') as k",
        "from_json(get_json_object(value, '$.events'), 'array<struct<minute: int>>').minute as m").collect()}
    by_key = {k.rsplit("/", 1)[1]: m for k, m in found.items() if k}
    assert by_key == {"3": [4, 4], "4": [5, 6, 5], "5": [6, 7, 8, 6],
                      "-3": [-2, -2], "-4": [-3, -4, -3], "-5": [-4, -5, -6, -4]}
    assert found[None] is None


def test_appearances_do_not_look_up_formations(spark):
    t = SimpleNamespace(
        orders=_orders(spark, [4]),
        lineitem=spark.createDataFrame([(4, 1)], "l_orderkey long, l_partkey long"))
    games = base.games(base.newest_games(league.raw_games(t)), base.newest_lineups(league.raw_game_lineups(t)))
    rows = base.appearances(league.raw_appearances(t), games)
    assert "formation" not in rows._jdf.queryExecution().optimizedPlan().toString()
