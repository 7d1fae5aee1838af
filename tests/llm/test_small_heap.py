"""Stages that hold whole texts: what Spark's reader and writer buffer in each task has to stay small."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from tickloom.llm.spark_io import READ_ROWS, ROW_GROUP, stored


def long_texts(seed, n, size):
    """n texts of about `size` bytes that hardly compress."""
    r = np.random.default_rng(seed)
    letters = r.integers(97, 123, (n, size), dtype=np.uint8)
    letters[:, ::7] = 32
    letters[:, 349::350] = 10
    return [x.tobytes().decode() for x in letters]


@pytest.mark.parametrize("own", [False, True])
def test_buffers_keep_what_a_session_chose(spark, tmp_path, own):
    s = spark.newSession()
    chosen = {"spark.sql.parquet.columnarReaderBatchSize": "1000", "parquet.block.size": str(32 << 20)}
    for name, value in chosen.items() if own else ():
        s.conf.set(name, value)
    texts = long_texts(9, 480, 60_000)
    docs = s.createDataFrame(pa.table({"doc_id": range(480), "text": texts, "lang": ["en"] * 480, "source": ["s"] * 480, "n_chars": [60_000] * 480})).coalesce(1)
    kept = stored(corpus_pipeline.rules(s, docs, str(tmp_path)), "small-heap")
    wanted = chosen if own else {"spark.sql.parquet.columnarReaderBatchSize": str(READ_ROWS), "parquet.block.size": str(ROW_GROUP)}
    assert {name: s.conf.get(name) for name in wanted} == wanted
    groups = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in kept.inputFiles()]
    largest = max(m.row_group(k).total_byte_size for m in groups for k in range(m.num_row_groups))
    assert largest < 1.5 * int(wanted["parquet.block.size"])
    assert sorted(tuple(r) for r in kept.select("doc_id", "text").collect()) == list(enumerate(texts))
