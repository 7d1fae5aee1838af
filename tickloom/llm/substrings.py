"""Removal of byte strings of `WIDTH` or more that occur more than once, by ranks of growing strings at anchors.

Texts are UTF-8 bytes and matches never cross texts. A byte goes if a 200-byte string over it also starts anywhere else,
in the same text or another, as the texts came in.

Prefix doubling over every byte needs a row for each byte and round (see README for what that costs). Here the positions
that are ranked are thinned first: each 200-byte window belongs to its anchor (see `anchors`), which equal windows have in
common, at the same distance. A rank is a 64-bit fingerprint: equal strings have equal ranks. Rounds extend the ranked
strings, Spark brings equal ranks together, and a position whose rank is unique drops out:

    1. 40 bytes at the anchor
    2. everything that the anchor's windows cover; repeated: all of them are done
    3. for blocks of 32 and then of 8 windows: the bytes common to a block (unique: the block drops out) and the bytes that
       the block covers (repeated: the block is done); blocks that are done stay as partners of open ones
    4. single windows, the full 200 bytes

Ranks alone only drop positions. What settles a range (2, the covers of 3, 4) is decided by the rank and a second,
independent fingerprint of the same bytes, 128 bits together. A text is known by its hash and its length.

What a round leaves is told to the next scan by bitmaps whose size follows the number of keys; beyond `key_filter.LIMIT_BITS`
nothing is broadcast: each text meets the list of its own live ranks by a join on the text's hash, for which the texts are
written once in buckets of that hash. Either may let too much pass, which costs rows, never too little. Removal is decided by
joins on ranks alone, which Spark can split where a rank is frequent. The texts are shuffled once, at the end, and only those
that lose bytes.

Defined results: null and empty texts lose nothing; equal texts of 200 bytes or more lose everything, shorter ones nothing;
repeated and null ids keep their rows; other columns, whatever their names, are carried as they are; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .anchors import GRAM, WIDTH, anchors
from .key_filter import Bitmap, Listed, bitmap_of
from .spark_io import discard, map_batches, own_dir, stored

#: Bytes of text ranked at once; a round holds some thirty numbers for each.
RANKED = 1 << 19
#: Longer texts are ranked in slices of so many bytes.
SLICE = 1 << 22
BLOCKS = (32, 8, 1)
#: Bytes of text in a bucket, where ranks are told by joins.
BUCKET = 256 << 20
TEXT = ["node", "n_bytes"]


@dataclass
class Level:
    """What a round has found: common ranks that repeat, covering ranks that do not, and the common ranks of positions that are
    still open, whose partners (settled or not) the next round needs too."""

    twice: Bitmap | Listed | None = None
    once: Bitmap | Listed | None = None
    kin: Bitmap | Listed | None = None


KINDS = ("twice", "once", "kin")


@dataclass
class Told:
    """A level as the driver has it: bitmaps to broadcast, or a DataFrame of each text's own lists of ranks."""

    bitmaps: Level | None
    lists: DataFrame | None = None


def salted(h: np.ndarray, *more: np.ndarray | int) -> np.ndarray:
    for x in more:
        h = K.mix(h + np.asarray(x).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return h


@dataclass
class Ranked:
    """Positions of a round: the rank of what their windows share, of what they cover (0: not all in the text), whether they are
    open, their first and last window, and the bytes [lo, hi) that settle them if they repeat."""

    core: np.ndarray
    cover: np.ndarray
    open: np.ndarray
    first: np.ndarray
    last: np.ndarray
    lo: np.ndarray
    hi: np.ndarray


def ranked(buf: np.ndarray, off: np.ndarray, levels: list[Level]) -> Ranked:
    """The positions of the round that follows `levels`: grams, whole anchors, then the sizes of BLOCKS."""
    run = K.prefix(buf)
    at, first, last = anchors(buf, off, run)
    gram = K.spans(run, at, at + GRAM)
    none = np.zeros(len(at), np.uint64)
    if not levels:
        return Ranked(gram, none, none > 0, first, last, at, at)
    live = levels[0].twice.has(gram)
    at, first, last, gram = at[live], first[live], last[live], gram[live]
    whole = salted(K.spans(run, first, last + WIDTH), at - first)
    if len(levels) == 1:
        return Ranked(gram, whole, np.ones(len(at), bool), first, last, first, last + WIDTH)
    op = levels[1].once.has(whole)
    live = op | levels[1].kin.has(gram)
    at, first, last, op = at[live], first[live], last[live], op[live]
    for size, level in zip(BLOCKS, [*levels[2:], None], strict=False):
        near, far = (at - last) // size, (at - first) // size  # blocks of distances from the start to the anchor
        count = far - near + 1
        k = np.repeat(np.arange(len(at)), count)
        d = (near[k] + np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)) * size
        at, op, first, last = at[k], op[k], np.maximum(first[k], at[k] - d - size + 1), np.minimum(last[k], at[k] - d)
        core = salted(K.spans(run, at - d, at - d - size + 1 + WIDTH), d, size)
        cover = np.zeros(len(at), np.uint64)
        lo, hi = at - d - size + 1, at - d + WIDTH
        if size > 1:
            doc = np.searchsorted(off, at, side="right") - 1
            fits = (lo >= off[doc]) & (hi <= off[doc + 1])
            cover[fits] = salted(K.spans(run, lo[fits], hi[fits]), d[fits], size, 3) | np.uint64(1)
            lo, hi = np.where(fits, lo, at), np.where(fits, hi, at)
        if level is None:
            return Ranked(core, cover, op, first, last, lo, hi)
        op &= (cover == 0) | level.once.has(cover)
        live = level.twice.has(core) & (op | level.kin.has(core))
        at, first, last, op = at[live], first[live], last[live], op[live]
    raise AssertionError


def thinned(r: Ranked, by_core: bool) -> np.ndarray:
    """Rows to send: every open one, and of other ones with the same ranks two. Ranks say all only if there is a cover, or `by_core`."""
    rest = np.flatnonzero(~r.open & (by_core | (r.cover != 0)))
    pair = K.mix(r.core[rest] + K.mix(r.cover[rest]))
    order = np.argsort(pair, kind="stable")
    third = np.zeros(len(rest), bool)
    third[order[2:]] = pair[order[2:]] == pair[order[:-2]]
    keep = np.ones(len(r.core), bool)
    keep[rest[third]] = False
    return keep


ROWS = ["core", "cover", "check", "open", "node", "n_bytes", "site", "first", "last"]


def slices(column: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, place in the text, buf, off) of runs of whole texts, or of a slice of a long text.

    Slices overlap by WIDTH - 1 bytes, so each window lies in one of them. A slice's edge is like a text's: what a block
    covers is not all there, so its windows are told apart in a later round.
    """
    for lo, hi, buf, off in K.text_chunks(column, RANKED):
        if len(buf) <= SLICE:
            yield lo, hi, 0, buf, off
        else:  # one text
            for at in range(0, len(buf) - WIDTH + 1, SLICE - WIDTH + 1):
                part = buf[at : at + SLICE]
                yield lo, hi, at, part, np.array([0, len(part)])


def round_rows(texts: DataFrame, levels: list[Told]) -> DataFrame:
    """The positions of the next round in all texts; starts count from the beginning of the text."""
    shared = texts.sparkSession.sparkContext.broadcast([x.bitmaps for x in levels])
    for k, x in enumerate(levels):
        if x.lists is not None:
            texts = texts.join(x.lists.select(*TEXT, *(F.col(c).alias(f"{c}_{k}") for c in KINDS)), TEXT, "left")
    by_core, checked = len(levels) in (0, 1 + len(BLOCKS)), bool(levels)

    def told(batch: pa.RecordBatch, lo: int, hi: int) -> list[Level]:
        own = lambda k: (Listed(batch.column(f"{c}_{k}").slice(lo, hi - lo).flatten().to_numpy()) for c in KINDS)
        return [bitmaps or Level(*own(k)) for k, bitmaps in enumerate(shared.value)]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        nodes, sizes, again, taken = batch.column("node").to_numpy(), batch.column("n_bytes").to_numpy(), set(), False
        for lo, hi, at, buf, off in slices(batch.column("text")):
            own, size = nodes[lo:hi], sizes[lo:hi]
            keep = np.array([at > 0 and taken or x not in again and not again.add(x) for x in zip(own.tolist(), size.tolist(), strict=True)], bool)  # equal texts of a batch once
            taken = bool(keep.any())  # the slices of a text go together
            if not keep.all():
                length = np.diff(off)[keep]
                buf, off, own, size = K.gather(buf, off[:-1][keep], length), np.concatenate([[0], np.cumsum(length)]), own[keep], size[keep]
            r = ranked(buf, off, told(batch, lo, hi))
            if len(r.core):
                send = np.flatnonzero(thinned(r, by_core))
                doc = np.searchsorted(off, r.first[send], side="right") - 1
                node, first, last = own[doc], r.first[send] - off[doc] + at, r.last[send] - off[doc] + at
                site = salted(node.view(np.uint64), first, last).view(np.int64)
                check = K.strings(K.wide(buf), buf, r.lo[send], r.hi[send]) if checked else r.cover[send]
                columns = (r.core[send].view(np.int64), r.cover[send].view(np.int64), check.view(np.int64), r.open[send], node, size[doc], site, first.astype(np.int32), last.astype(np.int32))
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ROWS)

    return map_batches(texts, run, "core long, cover long, check long, open boolean, node long, n_bytes int, site long, first int, last int")


def repeats(rows: DataFrame, keys: list[str], name: str, all_keys: bool = False) -> DataFrame:
    """The keys, and twice: whether more than one place has them; those of one place only with `all_keys`."""
    ranks = rows.groupBy(*keys).agg((F.min("site") != F.max("site")).alias("twice"))
    return stored(ranks if all_keys else ranks.where("twice"), name)


def settled(rows: DataFrame, ranks: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The byte ranges of open positions whose rank repeats."""
    again = ranks.where("twice").select(*keys)
    return stored(rows.where("open").join(again, keys).select(*TEXT, "first", (F.col("last") + WIDTH).alias("end")), name)


def tell(rows: DataFrame, cores: DataFrame | None, covers: DataFrame | None) -> Told:
    """What the next scan has to know of a round: bitmaps if they are small enough, else lists by text.

    cores: the common ranks that repeat, or None where those of all rows do; covers: None where rows have none.
    """
    twice = None if cores is None else cores.select(F.col("core").alias("key"))
    seen = None if cores is None else bitmap_of(twice, cores.count())
    if covers is None:
        return Told(Level(seen)) if seen else Told(None, listed(rows, {"twice": ("core", twice)}))
    once = covers.where("not twice").select(F.col("cover").alias("key"))
    alone = bitmap_of(once, once.count())
    if alone is None or cores is not None and seen is None:
        kin = rows.where("open").join(covers.where("twice").select("cover", "check"), ["cover", "check"], "left_anti").select(F.col("core").alias("key"))
        kin = (kin if cores is None else kin.join(twice, "key", "left_semi")).distinct()
        return Told(None, listed(rows, {"once": ("cover", once), "kin": ("core", kin)} | ({} if cores is None else {"twice": ("core", twice)})))
    shared = rows.sparkSession.sparkContext.broadcast((alone, seen))

    def pick(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        (alone, seen), core, cover = shared.value, batch.column("core").to_numpy(), batch.column("cover").to_numpy()
        live = (cover == 0) | alone.has(cover)
        yield pa.RecordBatch.from_arrays([pa.array(np.unique(core[live & seen.has(core) if seen else live]))], ["key"])

    still = rows.where("open").select("core", "cover")
    return Told(Level(seen, alone, bitmap_of(map_batches(still, pick, "key long"), still.count(), always=True)))


def listed(rows: DataFrame, keys: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """node, n_bytes and for each kind of key the ranks of the text that are among them: a list no longer than the text."""
    out = rows.select(*TEXT).distinct()
    for kind in KINDS:
        if kind in keys:
            rank, known = keys[kind]
            own = rows.select(*TEXT, F.col(rank).alias("key")).join(known, "key", "left_semi").groupBy(*TEXT).agg(F.collect_set("key").alias(kind))
            out = out.join(own, TEXT, "left")
        else:
            out = out.withColumn(kind, F.lit(None).cast("array<long>"))
    return stored(out, "rank-lists")


def bucketed(texts: DataFrame) -> DataFrame:
    """texts written once, each distinct one, in buckets of their hash: joins on it need no shuffle of texts."""
    spark, name = texts.sparkSession, f"tickloom_texts_{uuid.uuid4().hex}"
    size = texts.agg(F.coalesce(F.sum(F.col("n_bytes").cast("long")), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    buckets = min(buckets, 100_000)
    texts.dropDuplicates(TEXT).repartition(buckets, *TEXT).write.bucketBy(buckets, *TEXT).option("path", f"{own_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def repeated_spans(texts: DataFrame) -> list[DataFrame]:
    """texts (node, n_bytes, text) -> stored tables of (node, n_bytes, first, end): byte ranges, overlapping ones too, that repeated strings cover."""
    found, levels = [], []

    def done(level: Told) -> None:
        nonlocal texts
        if level.lists is not None and all(x.lists is None for x in levels):
            texts = bucketed(texts)
        levels.append(level)

    rows = round_rows(texts, levels)
    grams = repeats(rows, ["core"], "ranks-grams")
    done(tell(rows, grams, None))
    discard(grams)
    rows = stored(round_rows(texts, levels), "rows-whole")
    covers = repeats(rows, ["cover", "check"], "ranks-whole", all_keys=True)
    found.append(settled(rows, covers, ["cover", "check"], "spans-whole"))
    done(tell(rows, None, covers))
    discard(rows, covers)
    for size in BLOCKS:
        rows = stored(round_rows(texts, levels), f"rows-{size}")
        if size == 1:
            keys = ["core", "check"]
            cores = repeats(rows, keys, "cores-1")
            found.append(settled(rows, cores, keys, "spans-1"))
            discard(cores)
        else:
            cores, some = repeats(rows, ["core"], f"cores-{size}"), rows.where("cover <> 0")
            covers = repeats(some, ["cover", "check"], f"covers-{size}", all_keys=True)
            found.append(settled(some, covers, ["cover", "check"], f"spans-{size}"))
            done(tell(rows, cores, covers))
            discard(covers, cores)
        discard(rows)
    return found


def merged(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of ranges."""
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > end[:-1]
    at = np.flatnonzero(new)
    return first[at], end[np.append(at[1:], len(first)) - 1]


def without(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> bytes:
    """The bytes outside of ranges that are in order and do not overlap."""
    return b"".join(raw[a:b].tobytes() for a, b in zip([0, *end.tolist()], [*first.tolist(), len(raw)], strict=True))


def char_start(raw: np.ndarray, at: np.ndarray, step: int) -> np.ndarray:
    """The nearest starts of characters, or the end of the text, from places on in the direction of step."""
    at = at.copy()
    while len(inside := np.flatnonzero((at < len(raw)) & ((raw[np.minimum(at, len(raw) - 1)] & 0xC0) == 0x80))):
        at[inside] += step
    return at


def named_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, node, n_bytes of every row; a null text reads as empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumns({"node": F.xxhash64("text"), "n_bytes": F.octet_length("text")})


def span_lists(found: list[DataFrame], *more: DataFrame) -> DataFrame:
    """The different ranges of each text, however many copies it has; no more than the text has bytes. What is in found is deleted."""
    spans = functools.reduce(DataFrame.unionByName, [*found, *more])
    lists = stored(spans.groupBy(*TEXT).agg(F.collect_set(F.struct("first", "end")).alias("all")), "span-lists")
    discard(*found)
    return lists


def cut_texts(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """node, n_bytes, n_removed, n_spans, kept (binary), spans of each text that loses bytes."""
    bitmap = rows.sparkSession.sparkContext.broadcast(bitmap_of(lists.select(F.col("node").alias("key")), lists.count()))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that may lose bytes, equal ones once for each partition."""
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            some = bitmap.value.has(nodes) if bitmap.value else np.ones(len(nodes), bool)
            once = np.array([m and x not in seen and not seen.add(x) for m, x in zip(some.tolist(), zip(nodes.tolist(), batch.column("n_bytes").to_pylist(), strict=True), strict=True)], bool)
            got = batch.filter(pa.array(once))
            if got.num_rows:
                yield got

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {"node": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept": [], "spans": []}
        for node, size, text, spans in zip(batch.column("node").to_pylist(), batch.column("n_bytes").to_pylist(), batch.column("text"), batch.column("all"), strict=True):
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            first, end = merged(spans.values.field("first").to_numpy().astype(np.int64), spans.values.field("end").to_numpy().astype(np.int64))
            for c, x in zip(out, (node, size, int((end - first).sum()), len(first), without(raw, first, end), np.stack([first, end], 1).ravel().tolist()), strict=True):
                out[c].append(x)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("node", pa.int64()), ("n_bytes", pa.int32()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("spans", pa.list_(pa.int64()))]))

    some = rows.select(*TEXT, "text").mapInArrow(named, "node long, n_bytes int, text string")
    once = some.join(lists, TEXT).dropDuplicates(TEXT)
    return map_batches(once, cut, "node long, n_bytes int, n_removed long, n_spans long, kept binary, spans array<long>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    rows = named_texts(docs, id_col, text_col)
    known_rows = stored(rows.select("doc_id", *TEXT, F.sha2("text", 256).alias("sha256")), "substring-nodes")
    lists = span_lists(repeated_spans(rows.select(*TEXT, "text")))

    def digest(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*TEXT, "n_removed", "n_spans")), pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("kept")])], [*TEXT, "n_removed", "n_spans", "kept_sha256"])

    cut = stored(map_batches(cut_texts(rows, lists), digest, "node long, n_bytes int, n_removed long, n_spans long, kept_sha256 string"), "cut-texts")
    copies = known_rows.groupBy(*TEXT).agg(F.count("*").alias("copies")).where(f"copies > 1 and n_bytes >= {WIDTH}").select(*TEXT, F.lit(True).alias("copied"))
    known = stored(copies.join(cut, TEXT, "full"), "known-texts")
    discard(cut, lists)
    n_bytes = F.col("n_bytes").cast("long")
    return known_rows.join(known, TEXT, "left").select("doc_id", n_bytes.alias("n_bytes"), *(whole(a, b, c) for a, b, c in (("n_removed", n_bytes, F.lit(0).cast("long")), ("n_spans", F.lit(1).cast("long"), F.lit(0).cast("long")), ("kept_sha256", F.lit(hashlib.sha256(b"").hexdigest()), F.col("sha256")))))


def whole(name: str, if_copied: Column, if_not: Column) -> Column:
    """A text with copies goes whole; another has what was cut, or is as it was."""
    return F.when(F.coalesce("copied", F.lit(False)), if_copied).otherwise(F.coalesce(F.col(name), if_not)).alias(name)


def keep_unrepeated(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """docs with the repeated strings taken out of their texts; every row and column stays.

    A range is narrowed to whole characters. `chars_col`, where docs has it, is counted anew. Only rows that may lose
    bytes, by a bitmap of their nodes, are shuffled; where that would be too large, all are.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(text).alias("node"), F.octet_length(text).alias("n_bytes"))
    texts = rows.select(*TEXT, F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit("")).alias("text"))
    copied = texts.groupBy(*TEXT).agg(F.count("*").alias("c")).where(f"c > 1 and n_bytes >= {WIDTH}").select(*TEXT, F.lit(0).alias("first"), F.col("n_bytes").alias("end"))
    lists = span_lists(repeated_spans(texts), copied)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(lists.select(F.col("node").alias("key")), lists.count()))
    names, place = list(docs.columns), docs.columns.index(text_col)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns, out = batch.column("row").flatten(), []
        for text, spans in zip(columns[place], batch.column("all"), strict=True):
            if not spans.is_valid or not text.is_valid:
                out.append(text.as_py())
                continue
            raw = np.frombuffer(text.as_buffer(), np.uint8)
            first, end = merged(spans.values.field("first").to_numpy().astype(np.int64), spans.values.field("end").to_numpy().astype(np.int64))
            first, end = char_start(raw, first, 1), char_start(raw, end, -1)
            out.append(without(raw, first[first < end], end[first < end]).decode("utf-8", "replace"))
        columns[place] = pa.array(out, columns[place].type)
        yield pa.RecordBatch.from_arrays(columns, names)

    def named(hit: bool) -> DataFrame:
        """The rows whose text may have a list, or those whose text has none."""

        def pick(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            some = batch.filter(pa.array(shared.value.has(batch.column("node").to_numpy()) == hit))
            if some.num_rows:
                yield some

        return map_batches(rows, pick, rows.schema)

    joined = (named(True) if shared.value else rows).join(lists, TEXT, "left").select("row", "all")
    done = map_batches(joined, cut, docs.schema)
    if shared.value:
        done = done.union(named(False).select("row.*"))
    if chars_col in docs.columns:
        kind = dict(docs.dtypes)[chars_col]
        done = done.withColumn(chars_col, F.when(F.col(text_col).isNotNull(), F.char_length(text_col).cast(kind)).otherwise(F.col(chars_col)))
    return done
