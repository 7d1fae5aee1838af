"""Conflict-constrained best-fit packing of documents into bins of a fixed number of tokens.

Tokens are the ids of a byte-level vocabulary, or what a column says, or else white-space words; one more is the end of
each document.

Documents are dealt by a hash of their id to shards of about `SHARD` items, whatever the number of documents, and each
shard is packed alone: longest first, each item into the tightest bin that has room and neither its duplicate
cluster nor (unless `distinct_sources` is off) its source. Bins stand in the order of their residual; each carries a bitmap
of its sources and one of its clusters, and the search for a successor goes on from residual to residual until a
compatible bin is found, else a bin is opened. Bins with the same residual and bitmaps are interchangeable and held
together, so a hot source or cluster costs no scan of its bins.

A document longer than a bin is cut: full pieces have bins of their own, the rest is an item like any other. Every token of
every document is in exactly one bin.

Defined results: a null or empty text has one token, its end; a null source is a source of its own; rows with equal ids stay
separate items, told apart by `item`; rows equal in id and text go to shards of their own, however many they are; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .encode import byte_encoder
from .spark_io import map_batches, stored

CAPACITY, SHARD = 2048, 4000


def pack(length: np.ndarray, source: np.ndarray, cluster: np.ndarray, capacity: int, distinct_sources: bool = True) -> np.ndarray:
    """The bin of each item; items come in the order in which they are to be placed, none longer than capacity."""
    source = np.unique(source, return_inverse=True)[1] if len(source) else source
    _, cluster, size = np.unique(cluster, return_inverse=True, return_counts=True) if len(cluster) else (0, cluster, cluster)
    bit = np.cumsum(size > 1) - 1  # only a cluster of two or more needs a bit
    n_sources = int(source.max()) + 1 if len(source) else 0
    lacks = np.zeros((n_sources, capacity + 1), np.int32)  # bins of each residual that are free for a source
    free = np.ones((len(length) + 1, n_sources), np.int32)  # by bin
    level: list[dict[tuple[int, int], list[int]]] = [defaultdict(list) for _ in range(capacity + 1)]
    out, bins = np.empty(len(length), np.int64), 0
    for k, (need, s, c) in enumerate(zip(length.tolist(), source.tolist(), cluster.tolist(), strict=True)):
        own = 1 << s if distinct_sources else 0
        twin = 1 << int(bit[c]) if size[c] > 1 else 0
        rest, found = need, None
        while found is None and rest <= capacity:
            ahead = lacks[s, rest:] > 0
            step = int(ahead.argmax())
            if not ahead[step]:
                break
            rest += step
            found = next((m for m, held in level[rest].items() if held and not m[0] & own and not m[1] & twin), None)
            rest += found is None
        if found is None:
            b, masks, rest, bins = bins, (0, 0), capacity, bins + 1
        else:
            b, masks = level[rest][found].pop(), found
            if not level[rest][found]:
                del level[rest][found]
            lacks[:, rest] -= free[b]
        if distinct_sources:
            free[b, s] = 0
        level[rest - need][masks[0] | own, masks[1] | twin].append(b)
        lacks[:, rest - need] += free[b]
        out[k] = b
    return out


def counted(texts: pa.Array, vocabulary: str | None) -> np.ndarray:
    """Ids of each text, or words without a vocabulary."""
    count = (lambda buf, off: byte_encoder(vocabulary)(buf, off)[1]) if vocabulary else (lambda buf, off: K.per_text(K.words(buf, off)[2], len(off) - 1))
    return np.concatenate([count(buf, off) for _, _, buf, off in K.text_chunks(texts)])


def items_of(docs: DataFrame, id_col: str, text_col: str, source_col: str, capacity: int, cluster_col: str | None = None, vocabulary: str | None = None, tokens_col: str | None = None) -> DataFrame:
    """doc_id, source, cluster, piece, start, n_tokens: the tokens and the end of each document, in pieces of up to a bin."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    same = F.xxhash64(text)
    cluster = F.coalesce(F.col(cluster_col).cast("long"), same) if cluster_col else same
    known = F.coalesce(F.col(tokens_col).cast("long"), F.lit(0)) if tokens_col else text
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"), known.alias("known"))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = 1 + (batch.column("known").to_numpy() if tokens_col else counted(batch.column("known"), vocabulary))
        count = -(-n // capacity)
        k = np.repeat(np.arange(len(n)), count)
        piece = np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)
        size = np.minimum(capacity, n[k] - piece * capacity)
        at = pa.array(k)
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in ("doc_id", "source", "cluster")), pa.array(piece), pa.array(piece * capacity), pa.array(size)], ["doc_id", "source", "cluster", "piece", "start", "n_tokens"])

    return map_batches(rows, run, "doc_id long, source string, cluster long, piece long, start long, n_tokens long")


def dealt(items: DataFrame, shards: int) -> DataFrame:
    """items with their shard, by what an item is; of items that are equal in that, by their number."""
    key = ["doc_id", "piece", "cluster"]
    again = items.groupBy(*key).agg(F.count("*").alias("copies")).where("copies > 1")
    same = [items[c].eqNullSafe(again[c]) for c in key]
    marked = items.join(again, same[0] & same[1] & same[2], "left").select(items["*"], F.when(F.col("copies") > 1, items["item"]).otherwise(F.lit(0)).alias("salt"))
    return marked.withColumn("shard", F.pmod(F.xxhash64(*key, "salt"), F.lit(shards))).drop("salt")


def best_fit(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shard_items: int = SHARD, distinct_sources: bool = True, cluster_col: str | None = None, vocabulary: str | None = None, tokens_col: str | None = None) -> DataFrame:
    """bin_id, item, doc_id, piece, start, n_tokens, source, cluster of every piece of every document.

    `vocabulary`: the file of a byte-level tokenizer that counts, `tokens_col`: a column of counts. Without `cluster_col` only equal texts are a cluster; with it (the component_id of the n-gram join, say) what it names.
    """
    items = items_of(docs, id_col, text_col, source_col, capacity, cluster_col, vocabulary, tokens_col)
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "packing-items")
    shards = max(1, -(-items.count() // shard_items))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending"), ("source", "ascending"), ("item", "ascending")])
        source = table.column("source").combine_chunks().dictionary_encode()
        codes = source.indices.fill_null(len(source.dictionary)).to_numpy(zero_copy_only=False)
        bins = pack(table.column("n_tokens").to_numpy(), codes, table.column("cluster").to_numpy(), capacity, distinct_sources)
        return table.select(["item", "doc_id", "piece", "start", "n_tokens", "source", "cluster"]).add_column(0, "bin_id", pa.array((table.column("shard")[0].as_py() << 24) + bins))

    return dealt(items, shards).groupBy("shard").applyInArrow(run, "bin_id long, item long, doc_id long, piece long, start long, n_tokens long, source string, cluster long")
