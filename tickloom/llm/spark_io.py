"""Small helpers around Spark that the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`. Only where all run in one process may it be unset."""
    here = spark.conf.get("spark.checkpoint.dir", None)
    if here:
        return here
    at = spark.sparkContext._jsc.sc().getCheckpointDir()
    if at.isDefined():
        return at.get()
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
    here = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(here)
    return here


def own_dir(spark: SparkSession) -> str:
    """Where this application keeps what it stores."""
    return f"{shared_dir(spark).rstrip('/')}/tickloom/{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage is cut and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def clear(spark: SparkSession) -> None:
    """Deletes all that this application has stored; results that have not been written elsewhere can no longer be read."""
    at = spark._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Deletes what `stored` wrote, once nothing reads it any more."""
    for df in frames:
        jvm, path = df.sparkSession._jvm, df._stored_at
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs; whatever else the table holds, under whatever name, stays out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Rows in a batch for Python, where the session leaves it at Spark's 10,000: whole texts are long rows.
BATCH_ROWS = 1024


def small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


#: Rows of whole texts that Spark's Parquet reader decodes at once (4096 by default), and bytes that its writer buffers for each
#: task (`parquet.block.size`, 128 MB by default): what they take of the heap is multiplied by the tasks that share it.
READ_ROWS, ROW_GROUP = 256, 8 << 20


def small_buffers(spark: SparkSession) -> None:
    """Sets both for the session, each where it has its default; results stay as they are."""
    for name, usual, value in (("spark.sql.parquet.columnarReaderBatchSize", "4096", READ_ROWS), ("parquet.block.size", None, ROW_GROUP)):
        if spark.conf.get(name, usual) == usual and (usual or not spark.sparkContext._jsc.hadoopConfiguration().get(name)):
            spark.conf.set(name, str(value))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow over one batch at a time; empty batches are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)
                pa.default_memory_pool().release_unused()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)
