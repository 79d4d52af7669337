"""Players in a box score page: a walk that finds the options of its lists and the shots of its script."""

from __future__ import annotations

import functools
import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The words of a shot's call and description.
CALL, VERDICTS, BY, PLAYER = "addShot", ("made", "missed"), " by ", "player_"
#: An option element with its attributes and label, and a numeric value among the attributes.
ELEMENT = re.compile(r"<option\b([^>]*)>([^<]*)</option\b", re.I)
VALUE = re.compile(r"\svalue\s*=\s*(?:\"([0-9]+)\"|'([0-9]+)'|([0-9]+)(?=[\s/]|$))", re.I)
FIELDS = "kind string, pid string, name string, team string"
CHANGES = "season string, team string, name_game_time string, name_current string"


def options(page: str) -> Iterator[tuple[str, str]]:
    """(player id, name) of each option with a numeric value and a label."""
    for element in ELEMENT.finditer(page):
        value, name = VALUE.search(element[1]), element[2].strip()
        if value and name:
            yield value[1] or value[2] or value[3], name


def described(said: str) -> tuple[str, str] | None:
    """(player, team) of a call's text up to its first closing parenthesis: after a colon, a verdict, by, the player, and the team in parentheses."""
    after = said.partition(":")[2]
    while after:
        verdict, by, who = after.lstrip().partition(BY)
        name, opening, team = who.partition("(")
        if verdict in VERDICTS and by and name and opening and team:
            return name, team
        after = after.partition(":")[2]
    return None


def shots(page: str) -> Iterator[tuple[str, str, str]]:
    """(player, team, player id) of each call that tells of a made or missed shot.

    The team ends at the first closing parenthesis, and the id must stand before the next;
    a call whose team holds parentheses itself therefore tells of nothing.
    """
    for call in page.split(CALL)[1:]:
        inside = call.lstrip()
        if not inside.startswith("("):
            continue
        said, *rest = inside[1:].split(")", 2)
        found = described(said) if rest else None
        if found:
            for part in rest[0].split(PLAYER)[1:]:
                if digits := part[: len(part) - len(part.lstrip("0123456789"))]:
                    yield *found, digits
                    break


@functools.lru_cache(maxsize=65_536)
def display_code(name: str) -> str:
    """``Ana  María`` as ``ANA.MARIA``: character references decoded, accents dropped, other letters kept."""
    whole = unicodedata.normalize("NFKD", html.unescape(name))
    return ".".join("".join(c for c in whole if not unicodedata.combining(c)).upper().split())


def walk(bundles: DataFrame, keep: list[str], page: str = "box_score") -> DataFrame:
    """The kept columns with a row for each option (team null) and shot of the page, options first. A null page has none."""

    def scan(batches):
        for batch in batches:
            rows = [(i, *row) for i, p in enumerate(batch.column(page).to_pylist()) if p for row in [*(("option", pid, name, None) for pid, name in options(p)), *(("shot", pid, name, team) for name, team, pid in shots(p))]]
            at, *columns = zip(*rows, strict=True) if rows else [()] * 5
            kept = batch.select(keep).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(c, pa.string()) for c in columns]], [*keep, *[f.split()[0] for f in FIELDS.split(", ")]])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in bundles.select(*keep).schema]
    return bundles.select(*keep, page).mapInArrow(scan, ", ".join([*fields, FIELDS]))


def renamed(page: str) -> set[tuple[str, str, str]]:
    """(team, code at game time, present code) of the page's players whose codes differ; of options of one id, the last counts."""
    current = dict(options(page))
    found = {(team.strip(), display_code(name), display_code(current[pid])) for name, team, pid in shots(page) if pid in current} if current else set()
    return {(team, was, now) for team, was, now in found if was and now and was != now}


def renamed_players(bundles: DataFrame) -> DataFrame:
    """(season, team, name_game_time, name_current), once for each page and change."""

    def scan(batches):
        for batch in batches:
            rows = [(season, *change) for season, page in zip(batch.column("season").to_pylist(), batch.column("box_score").to_pylist(), strict=True) if page for change in sorted(renamed(page))]
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], [f.split()[0] for f in CHANGES.split(", ")])

    return bundles.select("season", "box_score").mapInArrow(scan, CHANGES)
