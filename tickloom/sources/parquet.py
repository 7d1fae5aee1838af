"""Ticker-partitioned Parquet: written by conversion, read by snapshots, and the snapshot sink."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.merge import COLUMNS

from .manifest import with_partition


def write_partitioned(ticks: DataFrame, path: str, n_partitions: int, mapping: DataFrame | None = None, require_all: bool = True) -> int:
    """One file for each partition, rows in file order; how many rows there are.

    Written under another name, checked there, and renamed: `path` comes to be whole or not at all. No rows, and (with
    require_all) a partition without rows, are errors. Delta encoding (writer version 2, no dictionary for numbers) suits the
    nearly sorted time and sequence columns.
    """
    spark, partial = ticks.sparkSession, f"{path}.{uuid.uuid4().hex}.part"
    dealt = with_partition(ticks, n_partitions, mapping).repartition(n_partitions, "partition").sortWithinPartitions("partition", "row_id")
    writer = dealt.write.option("compression", "zstd").option("parquet.writer.version", "v2")
    for c in ("sip_timestamp", "sequence_number", "row_id"):
        writer = writer.option(f"parquet.enable.dictionary#{c}", "false")
    try:
        writer.partitionBy("partition").parquet(partial)
        counts = {r["partition"]: r["n"] for r in spark.read.parquet(partial).groupBy("partition").agg(F.count("*").alias("n")).collect()}
        empty = [p for p in range(n_partitions) if p not in counts]
        if not counts or (require_all and empty):
            raise RuntimeError(f"{path}: no rows" if not counts else f"{path}: {len(empty)} of {n_partitions} partitions have no rows")
        delete(spark, path)
        rename(spark, partial, path)
    finally:
        delete(spark, partial)
    return sum(counts.values())


def rename(spark: SparkSession, path: str, to: str) -> None:
    name = spark._jvm.org.apache.hadoop.fs.Path
    if not name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(name(path), name(to)):
        raise OSError(f"{path} cannot be renamed to {to}")


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def is_complete(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/_SUCCESS")


def read_day(spark: SparkSession, path: str, date: str) -> DataFrame:
    """One day with its own column types (archives differ), `date`, and row_id (the place in the file where none is stored)."""
    rows = spark.read.parquet(path)
    if "row_id" not in rows.columns:
        rows = rows.withColumn("row_id", F.col("_metadata.row_index"))
    return rows.withColumn("date", F.lit(date))


def write_snapshots(snapshots: DataFrame, path: str) -> None:
    """One date and frequency: a file for each partition, in the order of ticker and interval. Partitions that are not in snapshots stay."""
    ordered = snapshots.select("partition", *COLUMNS).repartition("partition").sortWithinPartitions("partition", "ticker", "ts_interval")
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition").parquet(path)
