"""The catalog of datasets; its order is the build order."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    """One season-partitioned table.

    ``family`` names the array of a game payload that the table is taken from as it is;
    tables without one are derived. ``level`` is the grain: tables of games get a flag in
    the coverage index, tables of seasons do not.
    """

    name: str
    family: str | None = None
    level: str = "game"

    def stem(self, prefix: str = "") -> str:
        return f"{prefix}{self.name}"


CATALOG: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("team_ids", level="season"),
        Dataset("schedule"),
        Dataset("team_rosters", level="season"),
        Dataset("rosters", level="season"),
        Dataset("pbp", "pbp"),
        Dataset("player_box", "player_box"),
        Dataset("team_box", "team_box"),
        Dataset("lineups", "lineups"),
        Dataset("matchup_stints"),
        Dataset("possessions", "possessions"),
        Dataset("shots", "shots"),
    )
}


def game_level() -> list[str]:
    return [d.name for d in CATALOG.values() if d.level == "game"]


def flag_columns() -> list[str]:
    """The coverage flags, one per dataset of games."""
    return [f"in_{name}" for name in game_level()]


def dataset(name: str) -> Dataset:
    if name not in CATALOG:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(CATALOG)}")
    return CATALOG[name]
