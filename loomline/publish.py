"""Publishing hooks around the engine: release listings, uploads, and the audit of built against live seasons.

Nothing here touches Spark's data path, and every call out is injectable.
"""

from __future__ import annotations

import logging
import re
import subprocess
from collections.abc import Callable, Iterable

from loomline.functions.text import human_size
from loomline.registry import Dataset
from loomline.sinks import to_rds
from loomline.storage import is_local, store_for

log = logging.getLogger("loomline")
METADATA_TIMEOUT, UPLOAD_TIMEOUT = 180, 1800


class ListingUnavailable(RuntimeError):
    """The release host could not be asked, which is not the same as holding nothing."""


def run_gh(args: list[str], timeout: int = METADATA_TIMEOUT) -> str:
    done = subprocess.run(["gh", *args], capture_output=True, text=True, check=False, timeout=timeout)
    if done.returncode:
        raise RuntimeError(done.stderr.strip() or f"gh exited with {done.returncode}")
    return done.stdout


def list_assets(tag: str, repo: str, runner: Callable[[list[str]], str] = run_gh, attempts: int = 2) -> set[str] | None:
    """Names of a release's assets; None if there is no such release; ListingUnavailable if it cannot be told."""
    problem: Exception | None = None
    for _ in range(attempts):
        try:
            return set(runner(["release", "view", tag, "--repo", repo, "--json", "assets", "--jq", ".assets[].name"]).split())
        except (RuntimeError, OSError, subprocess.TimeoutExpired) as e:
            if "release not found" in str(e):
                return None
            problem = e
    raise ListingUnavailable(f"{tag}: {problem}")


def release_exists(tag: str, repo: str, lister: Callable[..., set[str] | None] = list_assets) -> bool:
    """Whether there is a release; if that cannot be told, assume so rather than make a second one."""
    try:
        return lister(tag, repo) is not None
    except ListingUnavailable:
        return True


def complete_seasons(names: Iterable[str], stem: str) -> set[int]:
    """Seasons of which both the parquet and the csv.gz are there."""
    found: dict[str, set[int]] = {"parquet": set(), "csv.gz": set()}
    for name in names:
        if m := re.fullmatch(re.escape(stem) + r"_(\d+)\.(parquet|csv\.gz)", name):
            found[m[2]].add(int(m[1]))
    return found["parquet"] & found["csv.gz"]


def built_seasons(dataset: Dataset, base: str, league: str) -> set[int]:
    names = store_for(base).names(f"{base}/{league}/{dataset.name}/parquet")
    return {int(m[1]) for n in names if (m := re.fullmatch(r"season=(\d+)", n))}


def staged(dataset: Dataset, season: int, base: str, league: str, prefix: str = "") -> dict[str, str]:
    """Paths of a unit's staged assets by kind."""
    stem = f"{base}/{league}/_release_build/{dataset.name}/{dataset.stem(prefix)}_{season}"
    return {kind: f"{stem}.{kind}" for kind in ("parquet", "csv.gz", "rds")}


def publish(dataset: Dataset, season: int, base: str, league: str, repo: str, *, prefix: str = "", dry_run: bool = False, runner: Callable[[list[str]], object] | None = None, exists: Callable[[str, str], bool] | None = None, make_rds: Callable[[str, str], None] | None = to_rds) -> dict:
    """Upload what is staged of a unit, making the release if it is missing; a failed rds only warns.

    An rds is made anew if it is missing or older than the parquet, and only on a local base.
    Assets of other file systems are fetched to be uploaded.
    """
    files, tag = staged(dataset, season, base, league, prefix), dataset.stem(prefix)
    parquet, rds, store = files["parquet"], files["rds"], store_for(base)
    stale = store.exists(parquet) and (not store.exists(rds) or store.modified(rds) < store.modified(parquet))
    if make_rds and stale and is_local(base):
        try:
            make_rds(parquet, rds)
        except (RuntimeError, OSError) as e:
            log.warning("%s %s: no rds: %s", dataset.name, season, e)
    present = [f for f in files.values() if store.exists(f)]
    call = runner or run_gh
    if not dry_run and not (exists or release_exists)(tag, repo):
        call(["release", "create", tag, "--repo", repo, "--title", tag, "--notes", tag])
    uploaded = 0
    for f in present:
        log.info("%s %s (%s)", "would upload" if dry_run else "upload", f, human_size(store.size(f)))
        if not dry_run:
            upload = ["release", "upload", tag, store.fetch(f), "--repo", repo, "--clobber"]
            call(upload) if runner else run_gh(upload, timeout=UPLOAD_TIMEOUT)
            uploaded += 1
    return {"tag": tag, "files": present, "uploaded": uploaded}


def audit(built: set[int], live: set[int]) -> tuple[list[int], list[int]]:
    """(built but not live, which is a gap; live but not built, which is only told)."""
    return sorted(built - live), sorted(live - built)


def pending_units(units: list[tuple[str, int]], done: set[tuple[str, int]]) -> list[tuple[str, int]]:
    """Units of a sweep that are not published yet, in their order."""
    return [u for u in units if u not in done]
