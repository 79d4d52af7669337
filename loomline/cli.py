"""Command line: build, check, sweep, master and name-changes."""

from __future__ import annotations

import argparse
import logging
import os
import sys

from loomline import publish
from loomline.registry import CATALOG

log = logging.getLogger("loomline")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomline")
    p.add_argument("--league", default="wbb", help="directory of the league below the roots")
    sub = p.add_subparsers(dest="command")
    b = sub.add_parser("build", help="build a dataset of a season, or all")
    b.add_argument("--dataset", choices=[*CATALOG, "all"], required=True)
    b.add_argument("--season", type=int, required=True)
    b.add_argument("--base", default=".")
    b.add_argument("--raw-root")
    b.add_argument("--crosswalk", help="parquet of team ids")
    b.add_argument("--repo")
    how = b.add_mutually_exclusive_group()
    how.add_argument("--publish", action="store_true")
    how.add_argument("--dry-run", action="store_true")
    c = sub.add_parser("check", help="compare built with published seasons")
    c.add_argument("--dataset", choices=[*CATALOG, "all"], default="all")
    c.add_argument("--base", default=".")
    c.add_argument("--repo", required=True)
    c.add_argument("--porcelain", action="store_true")
    w = sub.add_parser("sweep", help="build and publish what is not published yet, newest season first")
    w.add_argument("--first", type=int, required=True)
    w.add_argument("--last", type=int, required=True)
    w.add_argument("--base", default=".")
    w.add_argument("--raw-root")
    w.add_argument("--crosswalk")
    w.add_argument("--repo", required=True)
    w.add_argument("--parallel", type=int, default=1, help="seasons at a time")
    m = sub.add_parser("master", help="write the coverage tables")
    m.add_argument("--base", default=".")
    m.add_argument("--raw-root")
    n = sub.add_parser("name-changes", help="extract the name crosswalk from page bundles")
    n.add_argument("--season", action="append")
    n.add_argument("--limit", type=int, default=0)
    n.add_argument("--out", required=True)
    n.add_argument("--raw-root", help="else the environment's, else a sibling folder that ends in -raw")
    return p


def run_build(args) -> int:
    from loomline.plans.build import Season, build_all, build_season
    from loomline.session import build_session

    spark = build_session()
    crosswalk = spark.read.parquet(args.crosswalk) if args.crosswalk else None
    inputs = Season(spark, args.season, args.raw_root, args.league, crosswalk)
    kw = {"release": args.publish, "dry_run": args.dry_run, "repo": args.repo}
    if args.dataset == "all":
        build_all(inputs, args.base, **kw)
    else:
        build_season(inputs, args.dataset, args.base, **kw)
    return 0


def run_check(args, lister=publish.list_assets) -> int:
    """0 if every built season is live, 1 if some are not, 2 if that cannot be told."""
    gaps = 0
    for name in CATALOG if args.dataset == "all" else [args.dataset]:
        spec = CATALOG[name]
        try:
            live = publish.complete_seasons(lister(spec.stem(), args.repo) or set(), spec.stem())
        except publish.ListingUnavailable as e:
            log.error("cannot tell for %s: %s", name, e)
            return 2
        if args.porcelain:
            print(*[f"{name} {s}" for s in sorted(live)], sep="\n")
            continue
        missing, extra = publish.audit(publish.built_seasons(spec, args.base, args.league), live)
        log.info("%s missing=%s published_only=%s", name, missing, extra)
        gaps += len(missing)
    return 1 if gaps else 0


def run_sweep(args, lister=publish.list_assets, build_unit=None) -> int:
    """Every unit that is not live, newest season first; a season's games are parsed once for all its datasets.

    A failed unit does not stop the others. 1 if any failed, 2 if the live ones cannot be told.
    """
    try:
        live = {(name, s) for name, spec in CATALOG.items() for s in publish.complete_seasons(lister(spec.stem(), args.repo) or set(), spec.stem())}
    except publish.ListingUnavailable as e:
        log.error("cannot tell what is published: %s", e)
        return 2
    from loomline.plans import sweep

    units = publish.pending_units([(name, season) for season in range(args.last, args.first - 1, -1) for name in CATALOG], live)
    seasons = sweep.by_season(units)
    if build_unit:
        return 1 if sweep.run_units(seasons, lambda name, season: build_unit(args, name, season), args.parallel) else 0
    from loomline.plans.build import Season, build_season
    from loomline.session import build_session

    spark = build_session(**{"spark.scheduler.mode": "FAIR"})
    crosswalk = spark.read.parquet(args.crosswalk) if args.crosswalk else None
    inputs = {season: Season(spark, season, args.raw_root, args.league, crosswalk) for season in seasons}
    build = lambda name, season: build_season(inputs[season], name, args.base, release=True, repo=args.repo)
    return 1 if sweep.run_units(seasons, build, args.parallel, lambda season: inputs[season].release()) else 0


def run_master(args) -> int:
    from loomline.plans.build import build_masters
    from loomline.session import build_session

    build_masters(build_session(), args.base, args.raw_root, args.league)
    return 0


def run_name_changes(args) -> int:
    """2 if the tree or a season is missing, 1 if a file was unreadable (the table is still written)."""
    from loomline.plans import name_changes
    from loomline.session import build_session
    from loomline.sources import games as source

    spark = build_session()
    tree = source.bundle_tree(spark, args.raw_root, f"{args.league}/raw")
    have = source.folders(spark, tree)
    seasons = args.season or have
    if not have or set(seasons) - set(have):
        log.error("no raw tree for %s under %s", seasons or "any season", tree)
        return 2
    bundles = source.read_bundles(spark, tree, seasons, args.limit)
    name_changes.changes(bundles).coalesce(1).write.mode("overwrite").parquet(args.out)
    bad = name_changes.unreadable(bundles).count()
    if bad:
        log.error("%d unreadable files", bad)
    return 1 if bad else 0


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(stream=sys.stdout, level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    p = parser()
    args = p.parse_args(argv)
    run = {"build": run_build, "check": run_check, "sweep": run_sweep, "master": run_master, "name-changes": run_name_changes}.get(args.command)
    if run is None:
        p.print_help()
        return 2
    return run(args)
