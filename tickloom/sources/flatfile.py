"""Strictly typed gzip CSV files with a header, as DataFrames that know each row's place in its file."""

from __future__ import annotations

import gzip
import tempfile
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import FEED_COLUMNS, LONG, kept

#: What an empty quoted field is read as, to tell it from an empty unquoted one, which is null.
EMPTY = "\u0001empty"


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Decompresses gzip members one after another; NUL bytes after a member are padding, a cut-off member is an error."""
    engine, fresh, seen = zlib.decompressobj(31), True, False
    for chunk in chunks:
        while chunk:
            if fresh:
                if seen:
                    chunk = chunk.lstrip(b"\0")
                if not chunk:
                    break
                engine = zlib.decompressobj(31)
            fresh, seen = False, True
            data = engine.decompress(chunk)
            if data:
                yield data
            chunk = engine.unused_data if engine.eof else b""
            fresh = engine.eof
    if not fresh:
        raise EOFError("the compressed file ends in the middle of a member")


def trim_padding(source: str, target: str, size: int = 1 << 20) -> None:
    """Rewrites a local gzip file without the padding that Spark's codec does not read."""
    with open(source, "rb") as f, gzip.open(target, "wb", compresslevel=1) as out:
        for data in inflate(iter(lambda: f.read(size), b"")):
            out.write(data)


def hadoop_file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def ends_in_nul(spark: SparkSession, path: str) -> bool:
    """Whether the last byte of a gzip file is NUL: it may be padded, or its last member is short."""
    fs, at = hadoop_file(spark, path)
    size = fs.getFileStatus(at).getLen()
    if not path.endswith(".gz") or not size:
        return False
    stream = fs.open(at)
    try:
        stream.seek(size - 1)
        return stream.read() == 0
    finally:
        stream.close()


def write_trimmed(spark: SparkSession, source: str, target: str) -> None:
    """trim_padding for paths of any store, by way of the driver's temporary folder."""
    (source_fs, source_at), (target_fs, target_at) = hadoop_file(spark, source), hadoop_file(spark, target)
    with tempfile.TemporaryDirectory() as own:
        local = spark._jvm.org.apache.hadoop.fs.Path
        source_fs.copyToLocalFile(False, source_at, local(f"file://{own}/padded.gz"), True)
        trim_padding(f"{own}/padded.gz", f"{own}/clean.gz")
        target_fs.copyFromLocalFile(False, True, local(f"file://{own}/clean.gz"), target_at)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """The column names of the first line that is not blank."""
    first = spark.read.text(path).where(F.length(F.trim("value")) > 0).first()
    if first is None:
        raise ValueError(f"{path} has no header")
    return [c.strip().strip('"') for c in first["value"].split(",")]


def read_flatfile(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """The kept columns of a feed in declared order, and row_id: the row's place in the file.

    Columns are found by the header's names in any order; a kept column that is absent is an error, as is a row with
    another number of fields or a bad number in a kept column. Fields of other columns are not read as numbers. Only an
    empty unquoted field is null: `NA`, `NULL` and `nan` are tickers. Blank lines are passed by. A gzip file is read by one
    task, so ids rise in file order.
    """
    names = header_of(spark, path)
    columns = FEED_COLUMNS[feed]
    if lacking := [c for c in kept(feed) if c not in names]:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    rows = spark.read.schema(schema).options(header=True, mode="FAILFAST", emptyValue=EMPTY, nullValue="", enforceSchema=True, columnPruning=False).csv(path)
    # every declared column is looked at, so that a row with too few or too many fields cannot be pruned away
    placed = rows.select(F.monotonically_increasing_id().alias("row_id"), *[F.when(F.col(f"`{n}`") == EMPTY, F.lit("")).otherwise(F.col(f"`{n}`")).alias(n) for n in names])

    def typed(name: str):
        kind = columns[name]
        if kind == T.StringType():
            return F.col(name)
        got = F.col(name).try_cast(kind)
        bad = F.col(name).isNotNull() & got.isNull()
        return F.when(bad, F.raise_error(F.concat(F.lit(f"{name}: not a number: "), F.col(name))).cast(kind)).otherwise(got).alias(name)

    return placed.select(*[typed(c) for c in kept(feed)], F.col("row_id").cast(LONG))
