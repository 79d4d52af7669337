"""Time a season of invented games through the whole JSON path: ``python bench_season.py [GAMES] [FOLDER]``.

Writes GAMES payloads (6,000 by default, of 500 events, 60 stints and 24 box rows each) below
FOLDER once, builds the datasets one after the other, and prints one JSON line of seconds.
"""

from __future__ import annotations

import json
import os
import random
import sys
import time
from multiprocessing import Pool

EVENTS, STINTS = 500, 60
TEXTS = ["2pt layup pointsinthepaint; made - GIA.HALE, assist", "freethrow 1of2 made", "foul personal shooting;2freethrow", "turnover badpass team;", "timeout short", "3pt jumpshot missed", "rebound defensive"]


def player(team: int, k: int) -> str:
    return f"PLAYER{chr(65 + k)}.OF{team}"


def game(task: tuple[str, int]) -> None:
    folder, i = task
    rng, home, away = random.Random(i), i % 350, (i * 7 + 1) % 350
    on, scores, rows = [list(range(5)), list(range(5))], [0, 0], []
    for e in range(EVENTS):
        if rng.random() < 0.07:
            side, slot = rng.randrange(2), rng.randrange(5)
            on[side][slot] = rng.choice([k for k in range(12) if k not in on[side]])
        scores[rng.randrange(2)] += rng.choice([0, 0, 0, 2])
        row = {"period": 1 + e * 4 // EVENTS, "game_seconds": e * 5, "home_score": scores[0], "away_score": scores[1], "home": f"Team {home}", "away": f"Team {away}", "game_date": "01/07/2023", "poss_num": e // 3, "event_description": rng.choice(TEXTS), "event_id": e, "event_team": f"Team {home}", "shot_value": None, "clock": f"{e % 20:02d}:00", "sub_in": None}
        row |= {f"{n}_{k + 1}": player(t, p) for n, t, s in (("home", home, on[0]), ("away", away, on[1])) for k, p in enumerate(s)}
        rows.append(row)
    total = lambda v: {"total": v}
    shot = {"attempts": total(4), "made": total(2), "ast": None}
    stats = {"num_events": 9, "num_possessions": 4, "pts": 5, "plus_minus": 1, **dict.fromkeys(("fg", "fg_rim", "fg_mid", "fg_2p", "fg_3p", "ft"), shot), **dict.fromkeys(("orb", "drb", "to", "stl", "blk", "assist", "foul"), total(1))}
    side = lambda t: {"team": {"name": f"Team {t}"}, "year": {"value": 2023}}
    stints = [{"date": "2023-01-07", "location_type": "home", "start_min": s * 0.6, "end_min": s * 0.6 + 0.6, "duration_mins": 0.6, "score_info": {"start": {"scored": s, "allowed": s}, "end": {"scored": s, "allowed": s}, "start_diff": 0, "end_diff": 0}, "team": side(home), "opponent": side(away), "lineup_id": {"value": f"L{s}"}, "players": [{"code": "x", "id": {"name": player(home, (s + k) % 12)}} for k in range(5)], "players_in": [], "players_out": [], "team_stats": stats, "opponent_stats": stats} for s in range(STINTS)]
    box = [{"team": f"Team {t}", "player": player(t, k), "pts": k} for t in (home, away) for k in range(12)]
    with open(f"{folder}/{i}.json", "w") as f:
        json.dump({"contest_id": str(i), "pbp": rows, "lineups": stints, "player_box": box, "team_box": [], "shots": [], "possessions": []}, f)


def write_season(games: int, root: str) -> None:
    """The payloads, unless they are there."""
    if not os.path.isdir(f"{root}/wbb/json"):
        os.makedirs(f"{root}/wbb/json")
        with Pool(os.cpu_count()) as pool:
            pool.map(game, [(f"{root}/wbb/json", i) for i in range(games)], chunksize=32)


def build_season(spark, games: int, root: str) -> tuple[dict[str, float], dict[str, int]]:
    """(seconds, rows) of each dataset, built one after the other from one parse."""
    from loomline.plans import build

    ids = spark.range(games).selectExpr("cast(id as string) as contest_id", "'2023' as season")
    ids.coalesce(1).write.mode("overwrite").parquet(f"{root}/wbb/schedule_master.parquet")
    seconds, rows, inputs, begin = {}, {}, build.Season(spark, 2023, root, "wbb"), time.time()
    inputs.payloads  # noqa: B018 -- reads and parses every payload once
    seconds["parse"] = time.time() - begin
    for name in ("pbp", "matchup_stints", "lineups", "schedule", "rosters"):
        begin = time.time()
        rows[name] = build.build_season(inputs, name, f"{root}/out").count()
        seconds[name] = time.time() - begin
    inputs.release()
    return {k: round(v, 1) for k, v in seconds.items()}, rows


def main(games: int, root: str) -> dict:
    from pyspark.sql import SparkSession

    write_season(games, root)
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = SparkSession.builder.master(f"local[{cpus}]").config("spark.driver.memory", "16g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "32").config("spark.sql.session.timeZone", "UTC").config("spark.sql.files.openCostInBytes", "65536").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds, rows = build_season(spark, games, root)
    return {"metric": "season_seconds", "value": round(sum(seconds.values()), 1), "unit": "sec", "games": games, "seconds": seconds, "rows": rows}


if __name__ == "__main__":
    print(json.dumps(main(int(sys.argv[1]) if len(sys.argv) > 1 else 6000, sys.argv[2] if len(sys.argv) > 2 else "/tmp/loomline-season")))
