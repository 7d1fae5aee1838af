"""Fetching flat files: a listing of the store as a DataFrame, what is not here by an anti-join, copies made by Spark's tasks.

A place is a folder that pyarrow opens on every executor: a path they share, or a URI (`s3://bucket/prefix`, `gs://`, `hdfs://`). For
an S3 store with another endpoint, `Store` has the endpoint and the keys.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIX = ".csv.gz"
#: Bytes that a task holds of a file while it copies.
PIECE = 16 << 20


@dataclass(frozen=True)
class Store:
    """Where the remote files are."""

    uri: str
    endpoint: str | None = None
    keys: tuple[str, str] | None = None

    def open(self) -> tuple[fs.FileSystem, str]:
        if not self.uri.startswith("s3://") or not (self.endpoint or self.keys):
            return opened(self.uri)
        access, secret = self.keys or (None, None)
        return fs.S3FileSystem(access_key=access, secret_key=secret, endpoint_override=self.endpoint), self.uri.removeprefix("s3://")


def opened(place: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(place if "://" in place else f"file://{os.path.abspath(place)}")


def keys_of_environment() -> tuple[str, str] | None:
    """The two key variables, or None if neither is set (pyarrow then looks for credentials itself); one alone is an error."""
    found = {name: os.environ.get(name) for name in ("AWS_ACCESS_KEY_ID", "AWS_SECRET_ACCESS_KEY")}
    if lacking := [name for name, value in found.items() if not value]:
        if len(lacking) == 1:
            raise ValueError(f"{lacking[0]} is not set")
        return None
    return tuple(found.values())


def files(spark: SparkSession, store: Store, feeds: list[str], dates: list[str]) -> DataFrame:
    """feed, date, size of the files `feed/year/month/date.csv.gz` of the wanted days; each month of a feed is listed by a task."""
    months = spark.createDataFrame([(f, m) for f in feeds for m in sorted({d[:7] for d in dates})], "feed string, month string")

    def listing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store.open()
        for row in (r for b in batches for r in b.to_pylist()):
            folder = fs.FileSelector(f"{root}/{row['feed']}/{row['month'].replace('-', '/')}", allow_not_found=True)
            own = [f for f in system.get_file_info(folder) if f.type == fs.FileType.File and f.base_name.endswith(SUFFIX)]
            yield pa.RecordBatch.from_pydict({"feed": pa.array([row["feed"]] * len(own), pa.string()), "date": pa.array([f.base_name.removesuffix(SUFFIX) for f in own], pa.string()), "size": pa.array([f.size for f in own], pa.int64())})

    listed = months.repartition(max(1, months.count()), "feed", "month").mapInArrow(listing, "feed string, date string, size long")
    return listed.join(F.broadcast(spark.createDataFrame([(d,) for d in dates], "date string")), "date", "left_semi").select("feed", "date", "size")


def lacking(remote: DataFrame, here: DataFrame) -> DataFrame:
    """What is not here in the same size."""
    return remote.join(here, ["feed", "date", "size"], "left_anti")


def copy(source: fs.FileSystem, path: str, target: fs.FileSystem, to: str, size: int) -> None:
    """In pieces and under another name, which becomes the file's when all bytes are there."""
    part, done = f"{to}.{os.getpid()}.part", 0
    target.create_dir(os.path.dirname(to))
    try:
        with source.open_input_stream(path, compression=None) as f, target.open_output_stream(part, compression=None) as out:
            while data := f.read(PIECE):
                out.write(data)
                done += len(data)
        if done != size:
            raise OSError(f"{path}: {done} bytes in place of {size}")
        target.move(part, to)
    except BaseException:
        if target.get_file_info(part).type != fs.FileType.NotFound:
            target.delete_file(part)
        raise


def persist(work: Callable[[], None], pauses: list[float], sleep: Callable[[float], None] = time.sleep) -> str | None:
    """Does work, once more after each pause while it fails; the last failure, or None."""
    for pause in [*pauses, None]:
        try:
            return work()
        except (OSError, pa.ArrowException) as e:
            if pause is None:
                return f"{type(e).__name__}: {e}"[:500]
            sleep(pause)
    raise AssertionError


def pauses_of(retries: int, delay: float) -> list[float]:
    """Each pause twice as long as the one before."""
    if retries < 0:
        raise ValueError("retries must not be negative")
    return [delay * 2**k for k in range(retries)]


def fetched(files: DataFrame, store: Store, target: str, pauses: list[float]) -> DataFrame:
    """feed, date, size, seconds, error of every file, each copied by a task of its own."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, root), (here, top) = store.open(), opened(target)
        for row in (r for b in batches for r in b.to_pylist()):
            path, began = f"{row['feed']}/{row['date'][:4]}/{row['date'][5:7]}/{row['date']}{SUFFIX}", time.time()
            row["error"] = persist(lambda: copy(source, f"{root}/{path}", here, f"{top}/{path}", row["size"]), pauses)  # noqa: B023
            row["seconds"] = time.time() - began
            yield pa.RecordBatch.from_pylist([row], pa.schema([("feed", pa.string()), ("date", pa.string()), ("size", pa.int64()), ("seconds", pa.float64()), ("error", pa.string())]))

    return files.mapInArrow(fetch, "feed string, date string, size long, seconds double, error string")


def download(spark: SparkSession, store: Store, target: str, feeds: list[str], dates: list[str], workers: int = 4, retries: int = 3, delay: float = 10.0, dry_run: bool = False, log: Callable[[str], None] = print) -> int:
    """0, or 1 if a file could not be had; the others are had all the same. `workers` tasks copy, the largest files first."""
    pauses, remote = pauses_of(retries, delay), files(spark, store, feeds, dates)
    there = {r["date"] for r in remote.select("date").distinct().collect()}
    if none := sorted(set(dates) - there):
        log(f"no files for {len(none)} days: {', '.join(none[:10])}")
    todo = lacking(remote, files(spark, Store(target), feeds, dates)).orderBy(F.desc("size"), "feed", "date").collect()  # a row for each day and feed
    if dry_run:
        for r in todo:
            log(f"would fetch {r['feed']} of {r['date']} ({r['size']} bytes)")
        return 0
    # dealt like cards, so that every task begins with one of the largest
    hands = [todo[k :: max(1, workers)] for k in range(max(1, workers))]
    dealt = spark.createDataFrame([(k, r["feed"], r["date"], r["size"]) for k, hand in enumerate(hands) for r in hand], "hand int, feed string, date string, size long")
    ordered = dealt.repartitionByRange(max(1, workers), "hand").sortWithinPartitions("hand", F.desc("size")).select("feed", "date", "size")
    failed = 0
    for r in fetched(ordered, store, target, pauses).collect():
        failed += r["error"] is not None
        log(f"failed: {r['feed']} of {r['date']}: {r['error']}" if r["error"] else f"fetched {r['feed']} of {r['date']}: {r['size']} bytes in {r['seconds']:.1f} s")
    return int(failed > 0)
