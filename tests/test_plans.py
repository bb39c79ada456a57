"""Plan shape: top-k, single-shuffle pivot, broadcast seeds, no Python UDFs."""

from conftest import SF_SMALL
from touchline.operators import dims, reports
from touchline.plans.more_queries import eav_pivot_events
from touchline.plans.proxy import ProxyStar
from touchline.sources import seeds


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_topk_reports_use_take_ordered(spark):
    star = ProxyStar(spark, SF_SMALL)
    for fn in (reports.top_scorers, reports.consistent_players, reports.impactful_players,
               reports.best_goalkeepers, reports.aggressive_teams):
        assert "TakeOrderedAndProject" in _plan(fn(star)), fn.__name__


def test_eav_pivot_is_one_shuffle(spark):
    plan = _plan(eav_pivot_events(spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark, scratch):
    """On a stored star the report's filter and 5 of 35 columns reach Parquet."""
    from types import SimpleNamespace
    from touchline.sources.warehouse import conform
    star = ProxyStar(spark, SF_SMALL)
    conform(star.fact_player, "fact_player").write.parquet(f"{scratch}/fact_player")
    stored = SimpleNamespace(fact_player=spark.read.parquet(f"{scratch}/fact_player"),
                             dim_players=star.dim_players, dim_teams=star.dim_teams)
    plan = _plan(reports.best_goalkeepers(stored))
    assert "PushedFilters: [IsNotNull(Position), EqualTo(Position,G)" in plan
    assert ("ReadSchema: struct<Fixture_ID:bigint,Player_ID:bigint,Position:string,"
            "Goals_Conceded:int,Saves:int>") in plan


def test_seed_dimensions_are_broadcast(spark):
    from envelopes import fixture, fixtures_doc
    from touchline.sources.envelopes import parse_envelopes
    env = parse_envelopes(spark.createDataFrame([(fixtures_doc([fixture(1, 2, 3, 1, 0)]),)],
                                                "doc string"), "doc", "fixtures")
    assert "BroadcastHashJoin" in _plan(dims.fixtures_work(env, seeds.dim_seasons(spark)))


def test_no_python_udf_in_report_plans(spark):
    star = ProxyStar(spark, SF_SMALL)
    for df in (reports.standings(star), reports.standings(star, per_league=False),
               reports.home_away(star), reports.top_scorers(star)):
        plan = _plan(df)
        assert "PythonUDF" not in plan and "EvalPython" not in plan


def test_facts_scan_line_items_once_and_players_are_hashed(spark):
    star = ProxyStar(spark, SF_SMALL)
    facts = _plan(star.fact_team)
    assert facts.count("FileScan parquet") == 1 and facts.count("Exchange hashpartitioning") == 2
    assert "Window" not in facts and "Join" not in facts
    assert "SortAggregate" not in _plan(star.dim_players) and "SortAggregate" not in facts


def test_json_standings_land_no_player_documents(spark):
    import os
    from touchline.plans.json_proxy import JsonProxy
    proxy = JsonProxy(spark, SF_SMALL)
    reports.standings(proxy.star()).count()
    landed = sorted(os.listdir(proxy.landing.replace("file:", "")))
    assert landed == ["fixtures", "fixtures_statistics", "staged_fixtures", "staged_fixtures_statistics",
                      "staged_teams", "teams"]
