"""Synthetic game payloads with invented names."""

import gzip
import json
import os

HOME = ["ANA.BERG", "BEA.COLE", "CIA.DUNN", "DEE.EAST", "EVA.FORD"]
AWAY = ["GIA.HALE", "IDA.JOHN", "KIM.LANE", "LEA.MOSS", "MIA.NASH"]


def event(period, seconds, hs, as_, home=HOME, away=AWAY, poss=None, text="", **kw):
    row = {"period": period, "game_seconds": seconds, "home_score": hs, "away_score": as_, "home": "Alder", "away": "Birch St.", "game_date": "01/07/2023", "poss_num": poss, "event_description": text}
    row |= {f"home_{i + 1}": p for i, p in enumerate(home)} | {f"away_{i + 1}": p for i, p in enumerate(away)}
    return row | kw


def stats(n):
    t = lambda v: {"total": v}
    shot = lambda a, m: {"attempts": t(a), "made": t(m), "ast": None}
    return {"num_events": n, "num_possessions": n, "pts": 2 * n, "plus_minus": 1, **{k: shot(n, 1) for k in ("fg", "fg_rim", "fg_mid", "fg_2p", "fg_3p", "ft")}, **{k: t(1) for k in ("orb", "drb", "to", "stl", "blk", "assist", "foul")}}


def lineup(start, names, opponent=True, team="Alder"):
    player = lambda n: {"code": "x", "id": {"name": n}}
    row = {
        "date": "2023-01-07", "location_type": "home", "start_min": start, "end_min": (start or 0) + 2.5, "duration_mins": 2.5,
        "score_info": {"start": {"scored": 0, "allowed": 0}, "end": {"scored": 4, "allowed": 2}, "start_diff": 0, "end_diff": 2},
        "team": {"team": {"name": team}, "year": {"value": 2023}}, "opponent": {"team": {"name": "Birch St."}, "year": {"value": 2023}}, "lineup_id": {"value": "L1"},
        "players": [player(n) for n in names], "players_in": [player(""), player(names[0])], "players_out": [], "team_stats": stats(3),
    }
    return row | ({"opponent_stats": stats(2)} if opponent else {})


NAMES = ["Berg, Ana", "Cole, Bea", "Dunn, Cia", "East, Dee", "Ford, Eva"]
SUB = ["ZOE.YORK", *HOME[1:]]
GAME = {
    "contest_id": "101",
    "pbp": [
        event(1, 10, 0, 0, poss=1, text="jump"),
        event(1, 30, 2, 0, poss=1, text="2pt layup pointsinthepaint;fastbreak; made - GIA.HALE, assist"),
        event(1, 40, 2, 0, home=HOME[::-1], poss=2, text="turnover badpass team;"),  # another slot order is no break
        event(1, 50, 4, 0, home=[None, *HOME[1:]], poss=2),  # dropped; its points go to the next run
        event(1, 60, 4, 3, home=SUB, poss=None, text="freethrow 1of2 made"),
        event(1, 90, 6, 3, home=SUB, poss=3, text="foul personal shooting;2freethrow"),
        event(2, 100, 6, 5, home=SUB, poss=4, text="headcoachchallenge foul accepted"),
        event(2, 120, 9, 5, home=[None, *HOME[1:]], poss=4, text="timeout short"),  # trailing, so its points vanish
    ],
    "lineups": [lineup(5.0, NAMES), lineup(0.0, [*NAMES, "Sixth, Ida"], opponent=False), lineup(None, NAMES[:4]), lineup(5.0, NAMES)],
    "player_box": [{"team": "Alder", "player": "ANA.BERG", "pts": 3}, {"team": "Alder", "player": "ANA.BERG", "pts": 3}, {"team": None, "player": None, "pts": 0}],
    "team_box": [{"team": "Alder", "score": 9}, {"team": "Birch St.", "score": 5}],
    "shots": [{"x": 1, "label": 7}],
    "possessions": [],
}
OTHER = {"contest_id": "102", "pbp": [{"period": 1, "home": "Cedar", "away": "Dogwood", "home_score": None, "away_score": 4, "game_date": "01/09/2023"}], "player_box": [{"team": "Alder", "player": "ANA.BERG", "pts": 1}], "shots": [{"x": 2, "label": "seven"}], "lineups": None}
EMPTY = {"contest_id": "103", "pbp": [], "player_box": []}


def write_tree(root: str) -> None:
    os.makedirs(f"{root}/wbb/json")
    for game in (GAME, OTHER, EMPTY, {"contest_id": "999", "pbp": GAME["pbp"]}):
        with open(f"{root}/wbb/json/{game['contest_id']}.json", "w") as f:
            json.dump(game, f)
    with open(f"{root}/wbb/json/104.json", "w") as f:
        f.write('{"contest_id": "104", "pbp": [')
    os.makedirs(f"{root}/wbb/team_rosters/2023")
    player = {"name": "Berg, Ana", "player": "ANA.BERG", "clean_name": "Berg, Ana", "ht_inches": 72, "gp": "3"}
    for name, body in (("7", {"team_id": 7, "team": "Alder", "season": 2023, "players": [player, {"name": "Ames, Zoe"}]}), ("8", {"team": "Birch St.", "players": None}), ("9", None)):
        with open(f"{root}/wbb/team_rosters/2023/{name}.json", "w") as f:
            f.write(json.dumps(body) if body else "{broken")


def write_bundles(tree: str) -> None:
    os.makedirs(f"{tree}/2023")
    page = '<select><option value="5">Old Pick</option><option value="5"> Zoë  Ann&#39;s </option><option value="6">Same Name</option></select>addShot(1, "x: made by Zoe Smith(Alder ) player_5");addShot(2, "x: missed by Zoe Smith(Alder) player_5");addShot("x: made by Same Name(Alder) player_6")'
    for name, body in (("1", json.dumps({"pages": {"box_score": page}})), ("2", json.dumps({"pages": {"box_score": page}})), ("3", "{broken"), ("4", json.dumps({"pages": {}}))):
        with gzip.open(f"{tree}/2023/{name}.json.gz", "wt", encoding="utf-8") as f:
            f.write(body)
