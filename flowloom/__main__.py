"""Command line, for spark-submit or ``python -m flowloom``.

compute  compute and store tables over a range, inputs first
ls       stored or missing slots as ranges, paths, columns or options
topk     the rows of a feature with the highest score
deps     tables and everything they need
"""

from __future__ import annotations

import argparse
import random
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flowloom.operators.tables import top_k
from flowloom.plans.coverage import coverage_ranges
from flowloom.plans.catalog import build_registry
from flowloom.plans.resolve import Resolver, Settings
from flowloom.plans.slots import epoch, parse_moment
from flowloom.session import configure, ship_package
from flowloom.sources.feeds import read_ca_lists, read_rank_list


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="flowloom", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--seed", choices=["empty"], help="start histories without an earlier day from nothing")
    shared.add_argument("--root_dir", required=True, help="folder of raw logs, feeds and stored tables")
    shared.add_argument("--start_time", required=True, type=parse_moment, help="YYYY-MM-DD[ HH:MM:SS]")
    shared.add_argument("--end_time", default=datetime.now().strftime("%Y-%m-%d"), type=parse_moment)
    shared.add_argument("--home_site", default="home", help="site tag of the originating site")
    shared.add_argument("--suffixes", help="file with one public suffix rule per line")
    shared.add_argument("--rank_list", help="CSV with a host column, best rank first")
    shared.add_argument("--ca_list", action="append", default=[], metavar="CATEGORY=PATH")

    compute = commands.add_parser("compute", parents=[shared])
    compute.add_argument("names", nargs="*", help="all tables if none is named")
    compute.add_argument("--save_dir")
    compute.add_argument("--pick-one-random", action="store_true", help="only one missing slot of each feature")

    ls = commands.add_parser("ls", parents=[shared])
    ls.add_argument("names", nargs="*")
    ls.add_argument("--output_format", default="ranges", choices=["ranges", "paths", "columns", "options"])
    ls.add_argument("--missing", action="store_true", help="missing instead of existing slots")

    topk = commands.add_parser("topk", parents=[shared])
    topk.add_argument("feature")
    topk.add_argument("score_column")
    topk.add_argument("display_columns", nargs="*")
    topk.add_argument("--k", type=int, default=42)

    deps = commands.add_parser("deps")
    deps.add_argument("names", nargs="+")
    return parser


def _settings(spark: SparkSession, args) -> Settings:
    tables = {}
    if args.suffixes:
        tables["public_suffixes"] = lambda s: s.read.text(args.suffixes).select(F.trim("value").alias("suffix"))
    if args.rank_list:
        tables["rank_list"] = lambda s: read_rank_list(s, args.rank_list)
    if args.ca_list:
        lists = dict(item.split("=", 1) for item in args.ca_list)
        tables["ca_issuers"] = lambda s: read_ca_lists(s, lists)
    return Settings(home_site=args.home_site, tables=tables, seed=args.seed)


def compute(resolver: Resolver, args) -> None:
    names = args.names or list(resolver.registry)
    if not args.pick_one_random:
        for name, outcome in resolver.backfill(names, args.start_time, args.end_time, args.save_dir).items():
            print(f"{name}: {outcome}")
        return
    for name in names:
        absent = [slot for slot, there in resolver.status(name, args.start_time, args.end_time) if not there]
        if absent:
            start, end = random.choice(absent)
            print(name, start, end, resolver.backfill([name], start, end, args.save_dir)[name])


def ls(resolver: Resolver, args) -> None:
    names = args.names or [n for n in resolver.registry if resolver.store.slots_of(n)]
    for name in names:
        wanted = [s for s, there in resolver.status(name, args.start_time, args.end_time) if there != args.missing]
        if args.output_format == "ranges":
            print(f"\n[  {'missing' if args.missing else 'existing'}  {name} ]")
            for start, end in ranges(resolver, name, args.start_time, args.end_time, not args.missing):
                print(f"   {start}   --->   {end}")
        for start, end in wanted:
            if args.output_format == "paths":
                print(resolver.store.slot_path(name, (start, end)))
            elif args.output_format == "options":
                print(f"--start_time '{start}' --end_time '{end}' {name}")
            elif args.output_format == "columns" and not args.missing:
                d = resolver.store.describe(name, (start, end))
                print(" --- ".join(str(d[k]) for k in ("path", "modified", "count", "columns")))


def ranges(resolver: Resolver, name: str, start: datetime, end: datetime, present: bool) -> list[tuple[str, str]]:
    """Contiguous stored or missing ranges of a feature, in time order."""
    rows = [(name, epoch(s), epoch(e), there) for (s, e), there in resolver.status(name, start, end)]
    marked = resolver.spark.createDataFrame(rows, "feature string, s long, e long, present boolean").select(
        "feature", F.timestamp_seconds("s").alias("slot_start"), F.timestamp_seconds("e").alias("slot_end"), "present"
    )
    found = coverage_ranges(marked).where(F.col("present") == present).orderBy("range_start")
    text = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("range_start", "range_end")]
    return [tuple(r) for r in found.select(*text).collect()]


def topk(resolver: Resolver, args) -> None:
    df = resolver.get(args.feature, args.start_time, args.end_time)
    top_k(df, args.score_column, args.display_columns, args.k).show(args.k, truncate=False)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("flowloom").getOrCreate())
    ship_package(spark)
    registry = build_registry()
    if args.command == "deps":
        print("\n".join(registry.closure(args.names)))
        return
    resolver = Resolver(spark, registry, args.root_dir, settings=_settings(spark, args))
    {"compute": compute, "ls": ls, "topk": topk}[args.command](resolver, args)


if __name__ == "__main__":
    main()
