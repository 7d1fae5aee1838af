"""Vectorised text kernels shared by the corpus operators.

Every kernel works on a *chunk*: the concatenated UTF-8 bytes of some whole texts (`buf`, uint8) and their bounds
(`off`, int64, one more than there are texts). Chunks hold whole texts, so results never depend on how texts are
dealt to partitions or batches. Memory is a small multiple of the chunk: `CHUNK` bytes, or one text if that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once.
CHUNK = 2 << 20

_rng = np.random.default_rng(20240611)
#: One random odd multiplier and a random value for each byte: the polynomial fingerprint of a string.
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(1 << 61, 1 << 63)) | 1
BASE = BASE if BASE % 8 in (3, 5) else BASE + 2 if (BASE + 2) % 8 in (3, 5) else BASE + 4
BASE_INV = pow(BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, buf, off) of runs of whole texts of a string or binary column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, bounds, data = column.buffers()
    off = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
        lo = hi


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


#: The low bytes of a word that a string of so many bytes fills, and from how many bytes on a string is digested whole.
LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
DIGESTED = 512


def wide(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number, zeros after the end."""
    padded = np.zeros(len(buf) + 16, np.uint8)
    padded[: len(buf)] = buf
    out = np.empty(len(buf) + 1, np.uint64)
    for r in range(min(8, len(out))):
        own = out[r::8]
        own[:] = padded[r : r + 8 * len(own)].view("<u8")
    return out


def strings(at8: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit fingerprints of the substrings [start, end); at8 is `wide(buf)`. Each seed gives independent ones.

    Every eight bytes go through `mix`, which is not linear, so strings that polynomials modulo a power of two cannot tell
    apart (Thue-Morse words) differ. Strings of `DIGESTED` bytes or more go through BLAKE2b.
    """
    size = end - start
    h = mix(size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    live, at, left = slice(None), start, size
    while len(at):
        h[live] = mix(h[live] * np.uint64(0xD6E8FEB86659FD93) + (at8[at] & LOW[np.minimum(left, 8)]))
        more = np.flatnonzero((left > 8) & (left < DIGESTED)) if isinstance(live, slice) else np.flatnonzero(left > 8)
        live, at, left = more if isinstance(live, slice) else live[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(size >= DIGESTED).tolist():
        h[k] = int.from_bytes(hashlib.blake2b(buf[start[k] : end[k]], digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
    return h


_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n, modulo 2**64."""
    if len(_powers.get("up", ())) <= n:
        size = n + 1 + n // 4
        for name, base in (("up", BASE), ("down", BASE_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
    return _powers["up"], _powers["down"]


def prefix(buf: np.ndarray) -> np.ndarray:
    """Running fingerprints: `spans` reads that of any substring from them."""
    up, _ = powers(len(buf))
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE[buf] * up[: len(buf)], out=out[1:])
    return out


def spans(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Quick fingerprints of the substrings [start, end), to sort candidates only: some different strings have equal ones, so
    what decides is read from `strings`."""
    _, down = powers(len(run))
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the words `[^\\x20\\x09-\\x0D]+`."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACE[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] |= solid[cut]
    last[cut - 1] |= solid[cut - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def per_text(doc: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many items (or what weight) each of n texts has."""
    return np.bincount(doc, weights, n).astype(np.int64)


def lines(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the \\n-split lines, empty ones included."""
    nl = np.flatnonzero(buf == 10)
    start = np.sort(np.concatenate([off[:-1], nl + 1]), kind="stable")
    own = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, nl, side="right") - 1])
    own.sort(kind="stable")
    end = np.sort(np.concatenate([nl, off[1:]]), kind="stable")
    return start, end, own


def chained(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + w


def windows(w: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in the word list) where `size` words of one text begin, and the fingerprints of those runs."""
    n = len(w) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = chained(h, w[at + k])
    return at, mix(h)


def scoped(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Fingerprints that are equal only within one text."""
    return mix(h + doc.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def shingles(buf: np.ndarray, off: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, fingerprint) of the distinct `size`-word shingles of ASCII-lower-cased texts, sorted by both.

    A text of fewer words has its whole word sequence as one shingle; one without words has none.
    """
    low = LOWER[buf]
    start, end, doc = words(low, off)
    w = strings(wide(low), low, start, end)
    at, h = windows(w, doc, size)
    own = doc[at]
    n = per_text(doc, len(off) - 1)
    few = np.flatnonzero((n > 0) & (n < size))
    if len(few):
        first = np.concatenate([[0], np.cumsum(n)])[few]
        g = n[few].astype(np.uint64) + np.uint64(77)
        for k in range(size - 1):
            has = n[few] > k
            g[has] = chained(g[has], w[first[has] + k])
        own, h = np.concatenate([own, few]), np.concatenate([h, mix(g)])
    order = np.lexsort((h, own))
    own, h = own[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
    return own[new], h[new]


def gather(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices [start, start + length) of values, one after another."""
    total = int(length.sum())
    if not total:
        return values[:0]
    live = length > 0
    start, length = start[live], length[live]
    step = np.ones(total, np.int64)
    step[0] = start[0]
    at = np.cumsum(length)[:-1]
    step[at] = start[1:] - (start[:-1] + length[:-1] - 1)
    return values[np.cumsum(step)]
