"""Hand-written API envelopes (FIXTURES.md section B)."""

import json


def stats_doc(fixture, teams, get="fixtures/statistics"):
    """teams: list of (team_id, [(type, value), ...])"""
    return json.dumps({
        "get": get, "parameters": {"fixture": str(fixture)}, "results": len(teams),
        "response": [{"team": {"id": t, "name": f"T{t}"},
                      "statistics": [{"type": k, "value": v} for k, v in stats]}
                     for t, stats in teams]}, indent=4)


def fixture(fid, home, away, goals_home, goals_away, season=2023, league=39,
            country="England", date="2023-08-11T19:00:00+00:00", winner=None):
    if winner is None and goals_home is not None and goals_away is not None:
        winner = "home" if goals_home > goals_away else "away" if goals_away > goals_home else "draw"
    hw = {"home": True, "away": False}.get(winner)
    aw = {"home": False, "away": True}.get(winner)
    return {
        "fixture": {"id": fid, "date": date, "venue": {"id": 500 + home}, "status": {"short": "FT"}},
        "league": {"id": league, "name": f"League {league}", "country": country,
                   "logo": f"l{league}.png", "season": season},
        "teams": {"home": {"id": home, "winner": hw}, "away": {"id": away, "winner": aw}},
        "goals": {"home": goals_home, "away": goals_away},
    }


def fixtures_doc(items, get="fixtures"):
    return json.dumps({"get": get, "parameters": {"league": "39", "season": "2023"},
                       "results": len(items), "response": items}, indent=4)


def teams_doc(items, league="39"):
    return json.dumps({"get": "teams", "parameters": {"league": league, "season": "2023"},
                       "results": len(items), "response": [
                           {"team": {"id": t, "name": n, "logo": f"{t}.png", "country": c},
                            "venue": {"id": 500 + t, "name": f"{n} Park", "city": "X",
                                      "capacity": 1000 * t}} for t, n, c in items]}, indent=4)


def player(pid, name, stats_list):
    return {"player": {"id": pid, "name": name}, "statistics": stats_list}


def pstats(minutes=90, rating="7.1", goals=None, assists=None, position="M"):
    return {"games": {"minutes": minutes, "position": position, "rating": rating,
                      "substitute": False},
            "goals": {"total": goals, "conceded": 0, "assists": assists, "saves": None},
            "offsides": None}


def players_doc(fixture_id, teams):
    """teams: list of (team_id, [player, ...])"""
    return json.dumps({"get": "fixtures/players", "parameters": {"fixture": str(fixture_id)},
                       "results": len(teams),
                       "response": [{"team": {"id": t}, "players": ps} for t, ps in teams]},
                      indent=4)
