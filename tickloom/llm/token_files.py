"""Token ids in bit-packed shards and in flat files.

**Bit-packed shards.** A shard holds whole documents. Ids take the least number of bits that the vocabulary needs and are
packed in groups of 32 (`bits` little-endian 32-bit words each), so any group can be unpacked alone: block offsets
make a document readable without what precedes it. Layout, little-endian:

    magic "TKP2", bits u32, documents u64, ids u64, ids in a block u64
    doc ids   i64 x documents
    known     u8 x documents      0 where the doc id is null; padded to a multiple of 8
    doc ends  u64 x documents     ids up to and including each document's end id
    blocks    u64 x blocks        byte offset of each block in the packed part
    packed    u32 x ...

Shards are rows of a Parquet table (`shard`, `part`, `first`, `n_tokens`, `data`) written by Spark's committers, so a lost
executor or a repeated task leaves no half file on any file system; `export` writes them out as plain files.

**Flat files.** A flat stream is nothing but ids of two or four bytes, each document closed by an end id, without an
index; it is stored and read as fixed-size blocks that documents straddle.

Defined results: a null or empty text is a document of only its end id; equal or null doc ids stay separate documents,
null first; an empty table gives no shard and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernels as K
from .encode import byte_encoder, vocabulary_size
from .spark_io import ids_and_texts, map_batches, stored

MAGIC = b"TKP2"
#: Ids in a block of a shard, and about how many ids a shard takes before it is closed.
BLOCK, SHARD = 4096, 1 << 20
#: Bytes in a block of a flat stream.
FLAT_BLOCK = 1 << 20


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """ids at `bits` bits each, as little-endian 32-bit words; the last group is filled with zeros."""
    groups = -(-len(ids) // 32)
    x = np.zeros((groups, 32), np.uint64)
    x.reshape(-1)[: len(ids)] = ids
    out = np.zeros((groups, bits + 1), np.uint64)
    for k in range(32):
        word, shift = divmod(k * bits, 32)
        v = x[:, k] << np.uint64(shift)
        out[:, word] |= v & np.uint64(0xFFFFFFFF)
        out[:, word + 1] |= v >> np.uint64(32)
    return out[:, :bits].astype("<u4").reshape(-1)


def unpack(packed: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first n ids of what `pack` made."""
    w = np.zeros((len(packed) // bits, bits + 1), np.uint64)
    w[:, :bits] = packed.reshape(-1, bits)
    out = np.empty((len(w), 32), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for k in range(32):
        word, shift = divmod(k * bits, 32)
        out[:, k] = (((w[:, word] | w[:, word + 1] << np.uint64(32)) >> np.uint64(shift)) & mask).astype(np.uint32)
    return out.reshape(-1)[:n]


def write_shard(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray, bits: int, block: int = BLOCK, known: np.ndarray | None = None) -> bytes:
    known = np.ones(len(doc_ids), np.uint8) if known is None else known.astype(np.uint8)
    blocks = np.arange(-(-len(ids) // block), dtype="<u8") * (block // 32 * bits * 4)
    head = MAGIC + struct.pack("<IQQQ", bits, len(doc_ids), len(ids), block)
    return b"".join([head, doc_ids.astype("<i8").tobytes(), known.tobytes(), bytes(-len(known) % 8), np.cumsum(counts).astype("<u8").tobytes(), blocks.tobytes(), pack(ids, bits).tobytes()])


class Shard:
    """Reads a shard: all ids, those of a document, or any range, unpacking only the blocks it needs."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        self.bits, docs, self.n, self.block = struct.unpack_from("<IQQQ", data, 4)
        self.doc_ids = np.frombuffer(data, "<i8", docs, 32)
        self.known = np.frombuffer(data, np.uint8, docs, 32 + 8 * docs).astype(bool)
        at = 32 + 8 * docs + -(-docs // 8) * 8
        self.ends = np.frombuffer(data, "<u8", docs, at).astype(np.int64)
        n_blocks = -(-self.n // self.block)
        self.blocks = np.frombuffer(data, "<u8", n_blocks, at + 8 * docs)
        self.body, self.data = at + 8 * (docs + n_blocks), data

    def read(self, start: int, end: int) -> np.ndarray:
        if start >= end:
            return np.zeros(0, np.uint32)
        first = start // self.block
        skip = first * self.block
        words = -(-(min(-(-end // self.block) * self.block, self.n) - skip) // 32) * self.bits
        packed = np.frombuffer(self.data, "<u4", words, self.body + int(self.blocks[first]))
        return unpack(packed, self.bits, end - skip)[start - skip :]

    def document(self, k: int) -> np.ndarray:
        return self.read(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


#: Bytes of input, as Spark estimates them, in a range of doc ids, where the session's shuffle partitions would be larger.
RANGE_BYTES = 128 << 20


def ranges(df: DataFrame) -> int:
    """How many ranges to deal rows to: the session's shuffle partitions, or more where they would be too large."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    known = size if size < 1 << 60 else 0  # Spark says the largest number where it does not know
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // RANGE_BYTES))


def encode_texts(docs: DataFrame, path: str, end_id: int, special: bool, close, id_col: str, text_col: str, schema: str, in_order: bool) -> DataFrame:
    """Texts, in doc id order if so asked, through the encoder; `close(part, number, doc ids, whether they are known, counts, ids)` makes rows of what has gathered.

    One range shuffle of whole texts puts them in order, else there is no shuffle; a task holds what is between two calls of `close`.
    """
    rows = ids_and_texts(docs, id_col, text_col)
    if in_order:
        rows = rows.repartitionByRange(ranges(rows), F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encoder, number = TaskContext.get().partitionId(), byte_encoder(path, special), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            if held:
                yield close(part, number, *(np.concatenate(x) for x in zip(*held, strict=True)))
                number += 1
                held.clear()

        for batch in batches:
            known = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            doc_ids = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in K.text_chunks(batch.column("text"), 1 << 21):
                ids, count = encoder(buf, off)
                ends = np.cumsum(count)
                with_end = np.insert(ids, ends, ids.dtype.type(end_id))
                held.append((doc_ids[lo:hi], known[lo:hi], count + 1, with_end))
                if sum(len(x[3]) for x in held) >= SHARD:
                    yield from flush()
        yield from flush()

    return rows.mapInArrow(run, schema)


def write_token_shards(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text and stores the ids, in doc id order, as bit-packed shards in the shared folder.

    Returns the stored table: part, shard (both ascending in doc id order), n_tokens, n_bytes, data.
    """
    bits = max(1, (vocabulary_size(path) - 1).bit_length())

    def close(part, number, doc_ids, known, counts, ids):
        data = write_shard(doc_ids, counts, ids, bits, known=known)
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "shard": pa.array([number], pa.int64()), "n_tokens": [len(ids)], "n_bytes": [len(data)], "data": pa.array([data], pa.binary())})

    return stored(encode_texts(docs, path, end_id, True, close, id_col, text_col, "part long, shard long, n_tokens long, n_bytes long, data binary", in_order=True), "token-shards")


def shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard, first: ids before each shard, summed within parts and then over parts.

    The second sum runs over one row of two numbers for each part (128 MB of input or more), in one task.
    """
    inside = shards.select("part", "shard", "n_tokens").withColumn("before", F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens"))
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base"))
    return inside.join(parts, "part").select("part", "shard", (F.col("base") + F.col("before")).alias("first"))


def read_token_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the stored shards alone.

    Shards are read in place; only the small rows of documents meet the starts of their shards.
    """

    def read(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part, number, data in zip(*(batch.column(c) for c in ("part", "shard", "data")), strict=True):
            shard = Shard(data.as_py())
            raw = memoryview(shard.read(0, shard.n).astype("<u4").tobytes())
            begin = np.concatenate([[0], shard.ends[:-1]])
            crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(begin.tolist(), shard.ends.tolist(), strict=True)]
            n = len(begin)
            yield pa.RecordBatch.from_pydict({"part": pa.array([part.as_py()] * n, pa.int64()), "shard": pa.array([number.as_py()] * n, pa.int64()), "doc_id": pa.array(shard.doc_ids, mask=~shard.known), "at": begin, "n_tokens": shard.ends - begin, "ids_crc32": pa.array(crc, pa.int64())})

    read_back = map_batches(shards.select("part", "shard", "data"), read, "part long, shard long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return read_back.join(shard_starts(shards), ["part", "shard"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def export(shards: DataFrame, folder: str) -> int:
    """Writes each shard as a plain file `part-shard.tkp` into a folder (a path or URI that pyarrow opens and all executors share); how many there are.

    A file appears under its name when it is whole, so a task that is repeated leaves none in part.
    """

    def put(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        store, at = files_of(folder)
        store.create_dir(at)
        for part, number, data in zip(*(batch.column(c).to_pylist() for c in ("part", "shard", "data")), strict=True):
            partial = f"{at}/.{part:06}-{number:06}.{TaskContext.get().taskAttemptId()}"
            with store.open_output_stream(partial) as f:
                f.write(data)
            store.move(partial, f"{at}/{part:06}-{number:06}.tkp")
        yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    return map_batches(shards, put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_flat(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = FLAT_BLOCK) -> tuple[DataFrame, DataFrame]:
    """Encodes texts, in the order of the input, into flat streams, one for each task, and lists which document is which in them.

    Ids take two bytes, or four where the vocabulary needs them (`id_bytes`). Returns (blocks: stream, block, data) and
    (documents: stream, ordinal, doc_id), both stored. Strings of added tokens in a text are ordinary text here, so that an
    end id always ends a document.
    """
    schema, kind = "stream long, block long, data binary, base long, doc_ids array<long>", f"<u{id_bytes(path)}"

    def close(part, number, doc_ids, known, counts, ids):
        return pa.RecordBatch.from_pydict({"stream": pa.array([part], pa.int64()), "block": pa.array([number], pa.int64()), "data": pa.array([ids.astype(kind).tobytes()], pa.binary()), "base": pa.array([0], pa.int64()), "doc_ids": pa.ListArray.from_arrays([0, len(doc_ids)], pa.array(doc_ids, mask=~known))})

    encoded = encode_texts(docs, path, end_id, False, close, id_col, text_col, schema, in_order=False)

    def even(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of exactly block_bytes; only the last of a stream is shorter."""
        held, stream, number, base = b"", 0, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                stream, held = row["stream"], held + row["data"]
                done = 0
                while len(held) - done >= block_bytes:
                    yield pa.RecordBatch.from_pydict({"stream": [stream], "block": [number], "data": pa.array([held[done : done + block_bytes]], pa.binary()), "base": [base], "doc_ids": pa.array([[]], pa.list_(pa.int64()))})
                    done, number = done + block_bytes, number + 1
                held = held[done:]
                yield pa.RecordBatch.from_pydict({"stream": [stream], "block": [-1], "data": pa.array([None], pa.binary()), "base": [base], "doc_ids": pa.array([row["doc_ids"]], pa.list_(pa.int64()))})
                base += len(row["doc_ids"])
        if held:
            yield pa.RecordBatch.from_pydict({"stream": [stream], "block": [number], "data": pa.array([held], pa.binary()), "base": [base], "doc_ids": pa.array([[]], pa.list_(pa.int64()))})

    both = stored(encoded.mapInArrow(even, schema), "flat-tokens", compression="zstd")
    blocks = both.where("block >= 0").select("stream", "block", "data")
    listed = both.where("block < 0").select("stream", "base", F.posexplode("doc_ids").alias("k", "doc_id")).select("stream", (F.col("base") + F.col("k")).alias("ordinal"), "doc_id")
    return blocks, listed


def id_bytes(path: str) -> int:
    return 2 if vocabulary_size(path) <= 1 << 16 else 4


def files_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The pyarrow file system of a URI or plain path, and the path in it."""
    scheme, _, rest = uri.partition(":")
    return fs.FileSystem.from_uri(f"file:///{rest.lstrip('/')}" if scheme == "file" else uri if ":" in uri else f"file://{uri}")


def read_flat(spark: SparkSession, path: str, block_bytes: int = FLAT_BLOCK) -> DataFrame:
    """Blocks (stream: the file's path, block, data) of flat token files of any size.

    Spark lists the files; each block is a row that a task reads by its range alone, so a large file is shared by all tasks.
    Where only Spark's readers open a store, files are read whole and may have no more than 2 GB each.
    """
    schema, names = "stream string, block long, data binary", spark.read.format("binaryFile").load(path)

    def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, k in zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True):
            store, at = files_of(name)
            with store.open_input_file(at) as f:
                yield pa.RecordBatch.from_pydict({"stream": [name], "block": [k], "data": pa.array([f.read_at(min(block_bytes, f.size() - k * block_bytes), k * block_bytes)], pa.binary())})

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            for k in range(0, len(data), block_bytes):
                yield pa.RecordBatch.from_pydict({"stream": [name], "block": [k // block_bytes], "data": pa.array([data[k : k + block_bytes]], pa.binary())})

    some = names.select("path").first()
    try:
        files_of(some["path"] if some else "file:/")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return map_batches(names.select("path", "content"), cut, schema)
    last = F.ceil(F.col("length") / F.lit(block_bytes)) - 1
    ranges = names.where("length > 0").select("path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    return map_batches(ranges.repartition("path", "block"), part, schema)


def count_tokens(blocks: DataFrame, end_id: int, id_bytes: int = 2) -> DataFrame:
    """stream, ordinal, start, n_tokens (end id included) of every document of flat streams without an index.

    Each block is searched for end ids at once; blocks are stitched by a prefix scan over one small row for each: the
    running number of ids and of documents, and the running place of the last end id before the block. Ids after the
    last end id of a stream are one more document. A block whose bytes are no whole number of ids is an error.
    """
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k, data in enumerate(batch.column("data")):
            ids = np.frombuffer(data.as_buffer(), kind)
            ends = np.flatnonzero(ids == end_id)
            yield pa.RecordBatch.from_arrays([batch.column("stream").slice(k, 1), batch.column("block").slice(k, 1), pa.array([len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))], ["stream", "block", "n", "ends"])

    stream = dict(blocks.dtypes)["stream"]
    found = map_batches(blocks.select("stream", F.col("block").cast("long").alias("block"), "data"), search, f"stream {stream}, block long, n long, ends array<long>")
    found = found.withColumns({"docs": F.size("ends").cast("long"), "last": F.try_element_at("ends", F.lit(-1))})
    order = Window.partitionBy("stream").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    sums = found.withColumns({"base": F.coalesce(F.sum("n").over(before), F.lit(0)), "ordinal0": F.coalesce(F.sum("docs").over(before), F.lit(0)), "more": F.lead("block").over(order)})
    sums = sums.withColumn("open", F.coalesce(F.max(F.col("base") + F.col("last") + 1).over(before), F.lit(0)))
    tail = (F.col("more").isNull()) & (F.col("base") + F.col("n") > F.coalesce(F.col("base") + F.col("last") + 1, F.col("open")))
    ends = F.when(tail, F.concat("ends", F.array(F.col("n") - 1))).otherwise(F.col("ends"))
    rows = sums.withColumn("ends", ends).select("stream", "base", "ordinal0", "open", "ends", F.posexplode("ends").alias("k", "at"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("base") + F.get("ends", F.col("k") - 1) + 1)
    return rows.select("stream", (F.col("ordinal0") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("at") + 1 - start).alias("n_tokens"))
