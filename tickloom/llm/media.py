"""Media columns stored as content-defined chunks.

The payload of a row (its bytes, zero-padded to a positive multiple of 64) is stored as 8-bit mono PCM in a WAV file, so that
one sample is one byte. The samples are cut where a rolling gear hash has its low bits zero; a chunk is known by its
SHA-256. Every medium is an ordered list of chunk digests, from which it is rebuilt. Chunks seen once are kept beside the
list, as the rows are scanned and without a shuffle. Chunks seen more often are stored once: Spark groups the digests, and
the bytes of such chunks meet by digest. What may be shared is told to the scan by a bitmap that grows with the number of
shared digests; beyond `key_filter.LIMIT_BITS` every chunk counts as shared, which costs shuffling, never results.

Stores (Parquet, in the shared folder):
    manifest   doc_id, n_bytes, media_sha256, digests (the ordered chunk list)
    medium     media_sha256, digests, own          own: the bytes of each chunk of the list, null for shared ones
    chunk      digest, data                        shared chunks, each once

Reading takes each chunk of a list from `own` or from `chunk`, checks its SHA-256, joins them in order, checks the medium's
SHA-256 and computes the features from the samples read. Rows with equal bytes share one medium, so they have equal values;
a medium that cannot be rebuilt is an error.

Defined results: null and empty texts are a payload of 64 zero bytes; repeated rows and ids each keep a row; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .key_filter import Bitmap, bitmap_of
from .spark_io import discard, ids_and_texts, map_batches, stored

UNIT, RATE = 64, 8000
#: A cut needs so many low bits of the gear hash to be zero; no chunk but the last is shorter, and none longer.
CUT_BITS, SHORTEST, LONGEST = 11, 512, 16384
#: The gear value of each byte; a cut looks at low bits only, which the low 16 bits of the hash decide.
GEAR = np.random.default_rng(7).integers(0, 1 << 16, 256).astype(np.uint16)


def wav_header(n: int) -> bytes:
    """The 44 bytes before n 8-bit mono samples in a WAV file."""
    return b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", n)


def wav_samples(media: bytes) -> bytes:
    if media[:4] != b"RIFF" or media[36:40] != b"data":
        raise ValueError("not a medium of this store")
    return media[44 : 44 + struct.unpack_from("<I", media, 40)[0]]


def gear_marks(buf: np.ndarray) -> np.ndarray:
    """Places after which the gear hash of the last 64 bytes has its low CUT_BITS zero."""
    h = GEAR[buf]
    for k in (1, 2, 4, 8):  # low bits depend on the last CUT_BITS bytes only, so four doublings make the whole sum
        more = h.copy()
        more[k:] += h[: max(0, len(h) - k)] << np.uint16(k)
        h = more
    return np.flatnonzero(h & np.uint16((1 << CUT_BITS) - 1) == 0) + 1


def cuts(marks: list[int], n: int) -> list[int]:
    """Ends of the chunks of n bytes, given the marks in them in ascending order."""
    out, last = [], 0
    for m in marks:
        while m - last > LONGEST:
            last += LONGEST
            out.append(last)
        if m - last >= SHORTEST and m < n:
            out.append(m)
            last = m
    while n - last > LONGEST:
        last += LONGEST
        out.append(last)
    out.append(n)
    return out


def media_of(column: pa.Array) -> Iterator[tuple[int, int, bytes, list[int]]]:
    """(row, bytes, payload, ends of its chunks) of each text."""
    for lo, hi, buf, off in K.text_chunks(column):
        marks, raw = gear_marks(buf), buf.tobytes()
        near = np.searchsorted(marks, off, side="right")
        for k in range(hi - lo):
            s, e = int(off[k]), int(off[k + 1])
            n = e - s
            size = max(UNIT, -(-n // UNIT) * UNIT)
            yield lo + k, n, raw[s:e] + bytes(size - n), cuts([m - s for m in marks[near[k] : near[k + 1]].tolist() if m - s >= SHORTEST], size)


def pieces(payload: bytes, ends: list[int]) -> list[bytes]:
    return [payload[s:e] for s, e in zip([0, *ends], ends)]  # noqa: B905


def features(samples: bytes) -> str:
    """Mean, root of the mean square about the middle, share of sign changes, and the histogram over eight ranges."""
    x = np.frombuffer(samples, np.uint8)
    v = x.astype(np.int64) - 128
    turns = int(np.count_nonzero((v[1:] < 0) != (v[:-1] < 0)))
    bins = np.bincount(x >> 5, minlength=8).tolist()
    return f"mean={v.mean():.6f};rms={np.sqrt((v * v).mean()):.6f};turns={turns};bins={','.join(map(str, bins))}"


def row_of(key: str, chunks: list[tuple[bytes, bytes]]) -> dict:
    """What is read of the medium with this digest, from (digest, bytes) of its ordered chunks."""
    for digest, data in chunks:
        if hashlib.sha256(data).digest() != digest:
            raise ValueError(f"a stored chunk of {key} does not have its digest")
    samples = b"".join(data for _, data in chunks)
    media = wav_header(len(samples)) + samples
    if hashlib.sha256(media).hexdigest() != key:
        raise ValueError(f"the stored medium {key} does not have this digest")
    samples = wav_samples(media)
    return {"media_sha256": key, "payload_bytes": len(samples), "payload_sha256": hashlib.sha256(samples).hexdigest(), "tail_crc32": zlib.crc32(samples[-UNIT:]), "media_bytes": len(media), "feature": features(samples)}


READ = pa.schema([("media_sha256", pa.string()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("feature", pa.string())])
READ_SQL = "media_sha256 string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, feature string"


def key_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def write_manifest(rows: DataFrame) -> DataFrame:
    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, out = batch.column("doc_id"), {"doc_id": [], "n_bytes": [], "media_sha256": [], "digests": []}
        for k, n, payload, ends in media_of(batch.column("text")):
            for name, x in zip(out, (ids[k].as_py(), n, hashlib.sha256(wav_header(len(payload)) + payload).hexdigest(), [hashlib.sha256(p).digest() for p in pieces(payload, ends)]), strict=True):
                out[name].append(x)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media_sha256", pa.string()), ("digests", pa.list_(pa.binary()))]))

    return stored(map_batches(rows, scan, "doc_id long, n_bytes long, media_sha256 string, digests array<binary>"), "media-manifest")


def shared_digests(manifest: DataFrame) -> Bitmap | None:
    """The digests that more than one place of the table has, or None if they are too many for a bitmap."""
    shared = manifest.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1")

    def keys(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([key_of(x) for x in batch.column("digest").to_pylist()], pa.int64())], ["key"])

    found = stored(map_batches(shared.select("digest"), keys, "key long"), "media-shared")
    out = bitmap_of(found, found.count())
    discard(found)
    return out


OWN = pa.schema([("media_sha256", pa.string()), ("digests", pa.list_(pa.binary())), ("own", pa.list_(pa.binary())), ("chunk", pa.binary()), ("data", pa.binary())])


def store_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> dict[str, DataFrame]:
    """Writes the three stores and returns them by name."""
    rows = ids_and_texts(docs, id_col, text_col)
    manifest = write_manifest(rows)
    shared = rows.sparkSession.sparkContext.broadcast(shared_digests(manifest))

    def scan(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A row for each medium, and one for each chunk that may be shared (once for each batch)."""
        bitmap, press, out, seen, held = shared.value, zstandard.ZstdCompressor(level=3).compress, [], set(), 0
        for _, _, payload, ends in media_of(batch.column("text")):
            parts = pieces(payload, ends)
            digests = [hashlib.sha256(p).digest() for p in parts]
            maybe = bitmap.has(np.array([key_of(d) for d in digests], np.int64)) if bitmap else np.ones(len(parts), bool)
            if (key := hashlib.sha256(wav_header(len(payload)) + payload).hexdigest()) not in seen:
                seen.add(key)
                out.append((key, digests, [None if often else press(part) for part, often in zip(parts, maybe, strict=True)], None, None))
            for part, digest in ((p, d) for p, d, often in zip(parts, digests, maybe, strict=True) if often and d not in seen):
                seen.add(digest)
                out.append((None, None, None, digest, press(part)))
            held += len(payload)
            if held > K.CHUNK:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out, strict=True), OWN, strict=True)], schema=OWN)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*out, strict=True), OWN, strict=True)], schema=OWN)

    scanned = stored(map_batches(rows, scan, "media_sha256 string, digests array<binary>, own array<binary>, chunk binary, data binary"), "media-scan")
    chunk = stored(scanned.where("chunk is not null").groupBy(F.col("chunk").alias("digest")).agg(F.min("data").alias("data")), "media-chunks")
    return {"manifest": manifest, "medium": scanned.where("media_sha256 is not null").select("media_sha256", "digests", "own"), "chunk": chunk}


def read_media(stores: dict[str, DataFrame]) -> DataFrame:
    """One row for each distinct medium, rebuilt from its chunk list, checked, and measured."""

    def rebuilt(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out, unpress = [], zstandard.ZstdDecompressor().decompress
        for key, digests, data in zip(batch.column("media_sha256").to_pylist(), batch.column("digests"), batch.column("data"), strict=True):
            if None in (chunks := data.as_py()):
                raise ValueError(f"a chunk of {key} is not in the store")
            out.append(row_of(key, [(d, unpress(x)) for d, x in zip(digests.as_py(), chunks, strict=True)]))
        yield pa.RecordBatch.from_pylist(out, READ)

    # a chunk of its own is a chunk that no other place has, so only media of shared chunks alone have copies
    medium, shared, own = stores["medium"], F.exists("own", lambda x: x.isNull()), F.exists("own", lambda x: x.isNotNull())
    alone = map_batches(medium.where(~shared).select("media_sha256", "digests", F.col("own").alias("data")), rebuilt, READ_SQL)
    place = lambda df, *data: df.select("media_sha256", F.posexplode(F.arrays_zip("digests", *data)).alias("place", "x")).select("media_sha256", "place", F.col("x.digests").alias("digest"), *(F.col(f"x.{c}").alias("data") for c in data))
    mixed = place(medium.where(shared & own), "own")
    copies = place(medium.where(~own).select("media_sha256", "digests").dropDuplicates(["media_sha256"]))
    lacking = mixed.where("data is null").drop("data").unionByName(copies).join(stores["chunk"], "digest", "left").select(mixed.columns)
    lists = mixed.where("data is not null").unionByName(lacking).groupBy("media_sha256").agg(F.sort_array(F.collect_list(F.struct("place", "digest", "data"))).alias("x"))
    return alone.unionByName(map_batches(lists.select("media_sha256", F.col("x.digest").alias("digests"), F.col("x.data").alias("data")), rebuilt, READ_SQL))


def media_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores the payload of every row, reads it back and gives each row what was read."""
    stores = store_media(docs, id_col, text_col)
    read = stored(read_media(stores), "media-read")
    lost = F.raise_error(F.concat(F.lit("a medium cannot be rebuilt: "), F.col("media_sha256"))).cast("long")
    joined = stores["manifest"].select("doc_id", "n_bytes", "media_sha256").join(read, "media_sha256", "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", lost))
