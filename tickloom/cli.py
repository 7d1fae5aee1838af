"""Command line: download, convert, snapshot, run. Exit codes: 0 done, 1 some unit failed, 2 wrong usage, 130 interrupted."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tickloom import __version__
from tickloom.functions.intervals import parse_frequencies
from tickloom.functions.rules import trade_rules
from tickloom.plans import stages
from tickloom.sources import download
from tickloom.sources.layout import FEEDS, Layout, parse_dates


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="tickloom", description="Regularly sampled equity snapshots from quote and trade flat files.")
    out.add_argument("--version", action="version", version=f"%(prog)s {__version__}")
    out.add_argument("-q", "--quiet", action="store_true", help="say only what goes wrong")
    commands = out.add_subparsers(dest="command", required=True)
    for name in ("download", "convert", "snapshot", "run"):
        c = commands.add_parser(name)
        c.add_argument("--root", default=".", help="folder of all data")
        c.add_argument("--product", default="us_stocks_sip")
        for place in ("flatfiles", "parquet", "snapshots"):
            c.add_argument(f"--{place}", help=f"folder of the {place}, if not under root")
        c.add_argument("--dates", help="comma list of dates")
        c.add_argument("--start")
        c.add_argument("--end")
        if name in ("download", "run"):
            c.add_argument("--endpoint-url")
            c.add_argument("--bucket", default="flatfiles")
            c.add_argument("--remote", help="folder or URI of the remote files, in place of s3://BUCKET/PRODUCT")
            c.add_argument("--retries", type=int, default=3)
            c.add_argument("--retry-delay", type=float, default=10.0, help="seconds before the first retry; each pause is twice the one before")
            c.add_argument("--workers", type=int, default=4)
        if name == "download":
            c.add_argument("--dry-run", action="store_true")
        if name == "run":
            c.add_argument("--skip-download", action="store_true")
            c.add_argument("--log-dir")
        if name in ("download", "convert"):
            c.add_argument("--feeds", default=",".join(FEEDS))
        if name in ("convert", "run"):
            c.add_argument("--n-partitions", type=int, default=100)
            c.add_argument("--partition-map", help="Parquet table (ticker, partition) to keep the partitions of an older archive")
            c.add_argument("--allow-empty-partitions", action="store_true")
        if name in ("snapshot", "run"):
            c.add_argument("--freq-hz", default="1")
            c.add_argument("--conditions", help="JSON file of condition sets")
            c.add_argument("--overwrite", action="store_true")
        if name in ("convert", "snapshot"):
            c.add_argument("--log-file")
        if name in ("convert", "snapshot", "run"):
            c.add_argument("--days-at-once", type=int, default=4)
    return out


def session() -> SparkSession:
    return SparkSession.builder.appName("tickloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.sources.partitionOverwriteMode", "dynamic").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    try:
        a = parser().parse_args(argv)
    except SystemExit as e:
        return int(e.code or 0)
    try:
        layout = Layout(a.root, a.product, a.flatfiles, a.parquet, a.snapshots)
        dates = parse_dates(a.dates, a.start, a.end)
        freqs = parse_frequencies(a.freq_hz) if hasattr(a, "freq_hz") else []
        rules = trade_rules(a.conditions) if hasattr(a, "conditions") else None
        feeds = [f for f in getattr(a, "feeds", ",".join(FEEDS)).split(",") if f]
        if hasattr(a, "remote"):
            store = download.Store(a.remote or f"s3://{a.bucket}/{a.product}", a.endpoint_url, download.keys_of_environment())
            download.pauses_of(a.retries, a.retry_delay)
        if unknown := [f for f in feeds if f not in FEEDS]:
            raise ValueError(f"unknown feeds: {unknown}")
    except (ValueError, OSError) as e:
        print(f"tickloom: {e}", file=sys.stderr)
        return 2
    log = (lambda text: None) if a.quiet else print
    logs = {s: getattr(a, "log_file", None) or (f"{a.log_dir}/{s}.jsonl" if getattr(a, "log_dir", None) else None) for s in ("convert", "snapshot")}
    status = 0
    try:
        if a.command == "download" or a.command == "run" and not a.skip_download:
            status |= download.download(session(), store, f"{layout.flat_root()}/{a.product}", feeds, dates, a.workers, a.retries, a.retry_delay, getattr(a, "dry_run", False), log)
        if a.command in ("convert", "run"):
            spark = session()
            mapping = spark.read.parquet(a.partition_map) if a.partition_map else None
            status |= stages.convert(spark, layout, dates, feeds, a.n_partitions, mapping, logs["convert"], not a.allow_empty_partitions, a.days_at_once)
        if a.command in ("snapshot", "run"):
            status |= stages.snapshot(session(), layout, dates, freqs, rules, a.overwrite, logs["snapshot"], a.days_at_once)
    except KeyboardInterrupt:
        return 130
    return status
