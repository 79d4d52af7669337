"""Build one dataset of one season, or all of them over one parse of the season's games."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession

from loomline import publish, schemas, sinks
from loomline.plans import coverage, datasets, presence
from loomline.registry import CATALOG, dataset, game_level
from loomline.sources import games as source
from loomline.sources import http

log = logging.getLogger("loomline")
CSV_ORDER = {"team_ids": ["team", "id"], "team_rosters": ["team", "name"], "rosters": ["team", "player"], "matchup_stints": ["contest_id", "game_stint_num"]}
#: The family that a derived dataset is made of.
READS = {"schedule": "pbp", "rosters": "player_box", "matchup_stints": "pbp"}


class Season:
    """The inputs of a season, each opened when first asked for; games are parsed once for all datasets."""

    def __init__(self, spark: SparkSession, season: int, root: str | None, league: str, crosswalk: DataFrame | None = None):
        self.spark, self.season, self.league, self.crosswalk = spark, season, league, crosswalk
        self._root, self._payloads, self._missing, self._opened = root, None, 0, False

    @property
    def root(self) -> str:
        return source.resolve_root(self._root)

    @property
    def payloads(self) -> source.Payloads | None:
        """The payloads of the season's contests, None without an index or payloads."""
        if not self._opened:
            texts = self._fetched() if http.is_url(self.root) else self._listed()
            self._payloads, self._opened = None if texts is None else source.Payloads(texts), True
        return self._payloads

    @property
    def games(self) -> DataFrame | None:
        """The readable ones, with all their families."""
        return None if self.payloads is None else self.payloads.games()

    def _listed(self) -> DataFrame | None:
        """The season's payload files, chosen by name before any is opened; the index has some thousands a season."""
        index = source.read_index(self.spark, self.root, self.league)
        path = f"{self.root}/{self.league}/json"
        if index is None or not source.path_exists(self.spark, f"{path}/*.json"):
            return None
        ids = source.season_ids(index, self.season)
        files = source.payload_paths(self.spark, path)
        found = [r["path"] for r in ids.join(files, ids["contest_id"] == files["_cid"], "left").select("path").collect()]
        self._missing = found.count(None)
        return source.payload_texts(self.spark, [p for p in found if p]) if self._missing < len(found) else None

    def _fetched(self) -> DataFrame | None:
        """The season's payloads from an HTTP root, whose index is read on the driver and which has no league folder."""
        index = http.read_index(self.spark, self.root, [n.format(league=self.league) for n in source.INDEX_NAMES])
        if index is None:
            return None
        ids = [r["contest_id"] for r in source.season_ids(index, self.season).collect()]
        if not ids:
            return None
        payloads = http.read_payloads(self.spark, self.root, ids, os.environ.get(http.CACHE_ENV))
        return payloads.withColumnRenamed("contest_id", "_cid")

    def skipped(self) -> dict[str, int]:
        """How many contests of the season have no payload, and how many one that cannot be parsed; both were counted on the way."""
        if self.payloads is None:
            return {"missing": self._missing, "failed": 0}
        return {"missing": self._missing + self._payloads.absent, "failed": self._payloads.failed}

    def release(self) -> None:
        if self._payloads is not None:
            self._payloads.release()
        self._payloads, self._opened = None, False


def build(inputs: Season, name: str) -> DataFrame:
    """The table of a dataset for the season; without input an empty one."""
    spec, season, spark = dataset(name), inputs.season, inputs.spark
    if name == "team_ids":
        if inputs.crosswalk is None:
            raise ValueError("team_ids needs a crosswalk table")
        return datasets.team_ids(inputs.crosswalk, season)
    if name == "team_rosters":
        return datasets.team_rosters(source.read_roster_files(spark, inputs.root, inputs.league, season), season)
    if inputs.payloads is None:
        return spark.createDataFrame([], {"schedule": schemas.SCHEDULE, "rosters": schemas.ROSTERS}.get(name, schemas.EMPTY_FAMILY))
    reads = spec.family or READS[name]
    if refused := inputs.payloads.refused[reads]:
        log.warning("%s %s: %d games failed to extract", name, season, refused)
    if spec.family:
        return datasets.family(inputs.payloads.family(reads), reads, season)
    make = {"schedule": datasets.schedule, "rosters": datasets.rosters, "matchup_stints": datasets.matchup_stints}[name]
    return make(inputs.payloads.family(reads), season)


def build_season(inputs: Season, name: str, base: str, *, release: bool = False, repo: str | None = None, dry_run: bool = False, prefix: str = "") -> DataFrame:
    """Build, commit parquet and manifest row, and if asked stage csv.gz and parquet and publish them; an empty table writes nothing.

    Rows are counted by the write itself.
    """
    spec = dataset(name)
    df = build(inputs, name)
    staging = release or dry_run
    if staging:
        df = df.persist()
    try:
        if not sinks.commit_season(df, spec, inputs.season, base, inputs.league):
            log.warning("%s %s: no rows, nothing written", name, inputs.season)
            return df
        if staging:
            files = publish.staged(spec, inputs.season, base, inputs.league, prefix)
            sinks.write_csv_gz(df, files["csv.gz"], CSV_ORDER.get(name, [c for c in ("contest_id", "stint_num", "period", "game_seconds") if c in df.columns]))
            df.coalesce(1).write.mode("overwrite").parquet(files["parquet"])
            if repo:
                publish.publish(spec, inputs.season, base, inputs.league, repo, prefix=prefix, dry_run=dry_run)
        return inputs.spark.read.parquet(f"{sinks.dataset_root(spec, base, inputs.league)}/parquet").where(f"season = {inputs.season}")
    finally:
        if staging:
            df.unpersist()


def build_all(inputs: Season, base: str, **kw) -> dict[str, int]:
    """Rows of each dataset built for the season, in catalog order."""
    try:
        log.info("season %s: %s", inputs.season, inputs.skipped())
        return {name: build_season(inputs, name, base, **kw).count() for name in CATALOG if name != "team_ids" or inputs.crosswalk is not None}
    finally:
        inputs.release()


def build_masters(spark: SparkSession, base: str, root: str, league: str) -> list[str]:
    """Write the coverage index, the games present, and the coverage per season."""
    index = source.read_index(spark, source.resolve_root(root), league)
    numbers, bitmaps, read = presence.renew(spark, coverage.denominator(index), base, league, game_level())
    log.info("seasons read for their presence: %s", read)
    schedule = source.read_committed(spark, base, league, "schedule")
    full = coverage.build_index(index, {} if schedule is None else {"schedule": schedule}, (numbers, bitmaps)).persist()
    try:
        log.info("flags: %s", coverage.flag_totals(full).first())
        return sinks.write_masters(full, coverage.present_games(full), coverage.coverage(full), base, league)
    finally:
        full.unpersist()
