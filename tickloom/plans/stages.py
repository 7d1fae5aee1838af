"""The stages convert and snapshot over many days: what is done is skipped, what fails is reported, the rest goes on."""

from __future__ import annotations

import json
import os
import threading
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.intervals import freq_label
from tickloom.functions.rules import TradeRules, trade_rules
from tickloom.sources import parquet
from tickloom.sources.flatfile import ends_in_nul, read_flatfile, write_trimmed
from tickloom.sources.layout import FEEDS, Layout
from tickloom.sources.manifest import unit_status

from .snapshot import build_snapshots

_writing = threading.Lock()


def record(log_file: str | None, **entry) -> None:
    if log_file:
        os.makedirs(os.path.dirname(os.path.abspath(log_file)), exist_ok=True)
        with _writing, open(log_file, "a", encoding="utf-8") as f:
            f.write(json.dumps(entry) + "\n")


def each(spark: SparkSession, work: Callable[..., int], items: Iterable[tuple], at_once: int) -> int:
    """work(*item) of every item, some at once, so that the tail of one leaves no executor idle; 1 if any of them says so."""
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        run = inheritable_thread_target(spark)(work)
        return max([job.result() for job in [pool.submit(run, *item) for item in items]], default=0)


def convert(spark: SparkSession, layout: Layout, dates: Iterable[str], feeds: Iterable[str] = FEEDS, n_partitions: int = 100, mapping: DataFrame | None = None, log_file: str | None = None, require_all: bool = True, days_at_once: int = 4) -> int:
    """Flat files to partitioned Parquet; 0, or 1 if a file failed."""

    def one(feed: str, date: str) -> int:
        source, target = layout.flat_file(feed, date), layout.parquet_dir(feed, date)
        if parquet.is_complete(spark, target) or not parquet.exists(spark, source):
            return 0
        began, entry, clean = time.time(), {"feed": feed, "date": date}, f"{target}.trimmed.csv.gz"
        try:
            if ends_in_nul(spark, source):
                write_trimmed(spark, source, clean)
                source = clean
            entry["rows"] = parquet.write_partitioned(read_flatfile(spark, source, feed), target, n_partitions, mapping, require_all)
        except Exception as e:
            entry["error"] = f"{type(e).__name__}: {e}"[:500]
        finally:
            parquet.delete(spark, clean)
        record(log_file, **entry, seconds=round(time.time() - began, 3))
        return int("error" in entry)

    return each(spark, one, [(feed, date) for feed in feeds for date in dates], days_at_once)


def done_partitions(spark: SparkSession, path: str) -> set[int]:
    """Partitions of a snapshot that have been written."""
    if not parquet.exists(spark, path):
        return set()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = (s.getPath().getName() for s in at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at))
    return {int(n.partition("=")[2]) for n in names if n.startswith("partition=")}


def apart(units: list[int], build: Callable[[list[int]], None]) -> dict[int, str]:
    """build(units); where that fails, each half of them, down to the units at fault, which are returned with their errors."""
    try:
        build(units)
        return {}
    except Exception as e:
        if len(units) == 1:
            return {units[0]: f"{type(e).__name__}: {e}"[:500]}
    half = len(units) // 2
    return apart(units[:half], build) | apart(units[half:], build)


def snapshot(spark: SparkSession, layout: Layout, dates: Iterable[str], freqs: list[float], rules: TradeRules | None = None, overwrite: bool = False, log_file: str | None = None, days_at_once: int = 4) -> int:
    """Snapshots of each day for the frequencies that are not all there; 0, or 1 if a unit failed.

    Units that cannot be processed are found first, reported and left out, as are units whose rows turn out to be bad. A unit
    without quotes is none. Units that lack a frequency are built once for all frequencies they lack. The log has a line
    for each day and one for each unit: its rows by frequency, or what was wrong.
    """
    rules = rules or trade_rules()

    def one(date: str) -> int:
        paths = {feed: layout.parquet_dir(feed, date) for feed in FEEDS}
        if not parquet.is_complete(spark, paths["quotes_v1"]):
            return 0
        began, entry = time.time(), {"date": date, "frequencies": [freq_label(f) for f in freqs]}
        try:
            quotes, trades = (parquet.read_day(spark, paths[feed], date) for feed in FEEDS)
            states = {r["partition"]: r["status"] for r in unit_status(quotes, trades, rules).collect()}
            bad = {p: s for p, s in states.items() if s not in ("ok", "no quotes")}
            good = {p for p, s in states.items() if s == "ok"}
            lacking = {f: good if overwrite else good - done_partitions(spark, layout.snapshot_dir(f, date)) for f in freqs}
            groups: dict[frozenset[int], list[float]] = {}
            for f, units in lacking.items():
                if units:
                    groups.setdefault(frozenset(units), []).append(f)
            for units, own in groups.items():
                bad |= apart(sorted(units), lambda some, own=own: write(date, quotes, trades, some, own))
            entry["units"] = len(frozenset().union(*groups) - bad.keys())
            if bad:
                entry["failed"] = {str(p): s for p, s in sorted(bad.items())}
        except Exception as e:
            entry["error"] = f"{type(e).__name__}: {e}"[:500]
        record(log_file, **entry, seconds=round(time.time() - began, 3))
        return int("error" in entry or "failed" in entry)

    def write(date: str, quotes: DataFrame, trades: DataFrame, units: list[int], own: list[float]) -> None:
        began, some = time.time(), F.col("partition").isin(units)
        built = build_snapshots(quotes.where(some), trades.where(some), own, rules).persist()
        try:
            rows: dict[int, dict[str, int]] = {p: {} for p in units}
            for r in built.groupBy("partition", "freq").agg(F.count("*").alias("n")).collect():
                rows[r["partition"]][r["freq"]] = r["n"]
            for f in own:
                parquet.write_snapshots(built.where(F.col("freq") == freq_label(f)), layout.snapshot_dir(f, date))
        finally:
            built.unpersist()
        for p in units:
            record(log_file, date=date, partition=p, rows=rows[p], seconds_of_group=round(time.time() - began, 3), units_of_group=len(units))

    return each(spark, one, [(d,) for d in dates], days_at_once)
