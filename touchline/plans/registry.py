"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from touchline.operators import reports
from touchline.plans.proxy import ProxyStar

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> ProxyStar:
    return ProxyStar(spark, sf_dir)


REPORT_QUERIES: dict[str, Query] = {
    "standings_global": lambda s, d: reports.standings(_star(s, d), per_league=False),
    "standings_per_league": lambda s, d: reports.standings(_star(s, d), per_league=True),
    "standings_corrected": lambda s, d: reports.standings(_star(s, d), per_league=True,
                                                          corrected=True),
    "top_scorers": lambda s, d: reports.top_scorers(_star(s, d)),
    "home_away": lambda s, d: reports.home_away(_star(s, d), single_pass=False),
    "home_away_single_pass": lambda s, d: reports.home_away(_star(s, d), single_pass=True),
    "consistent_players": lambda s, d: reports.consistent_players(_star(s, d)),
    "impactful_players": lambda s, d: reports.impactful_players(_star(s, d)),
    "best_goalkeepers": lambda s, d: reports.best_goalkeepers(_star(s, d)),
    "aggressive_teams": lambda s, d: reports.aggressive_teams(_star(s, d)),
}


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(REPORT_QUERIES)
    from touchline.plans.json_proxy import JSON_QUERIES
    out.update(JSON_QUERIES)
    from touchline.plans.more_queries import MORE_QUERIES
    out.update(MORE_QUERIES)
    from touchline.plans.growth_queries import GROWTH_QUERIES
    out.update(GROWTH_QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    from touchline.plans.oracles import report_oracles
    out: dict[str, str] = {}
    out.update(report_oracles())
    from touchline.plans.json_oracles import json_oracles
    out.update(json_oracles())
    from touchline.plans.more_oracles import more_oracles
    out.update(more_oracles())
    from touchline.plans.growth_oracles import growth_oracles
    out.update(growth_oracles())
    return out
