"""BPE encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding by concatenation.

For files of the tokenizers library whose model has an end-of-word suffix and whose pre-tokeniser keeps what a pattern
matches (white space is dropped). Added tokens in a text are found first, in the text as it is; the rest is normalised
(NFC, white space, lower case), split, and each piece merged. The decoder is what the file states: none, so that the
vocabulary strings are joined by single spaces.

Defined results: a null or empty text has no ids and decodes to the empty string; symbols that are not in the
vocabulary yield no id, as the file has no unknown token.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import kernels as K
from .encode import AS_CHAR
from .memo import UnitMemo
from .spark_io import ids_and_texts, map_batches

#: White space beyond ASCII: with it in a text, words of the text are not what ASCII white space parts.
WIDE_SPACE = rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"


def lower(text: str) -> str:
    """Lower case character by character: no rule for the last sigma of a word."""
    return "".join(c.lower() for c in text) if "Σ" in text else text.lower()


class Bpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.merges = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        if any(t.get(k) for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"{path}: added tokens that take in or depend on their surroundings are not supported")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.unusual = regex.compile(b"|".join([WIDE_SPACE, *(regex.escape(t.encode(), special_only=True) for t in self.added)]))
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.pattern = regex.compile(next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"))
        self.strings: list[str] = [""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for token, k in [*self.vocab.items(), *self.added.items()]:
            self.strings[k] = token
        self.raw = [t.encode() for t in self.strings]
        self.plain = [self.vocab.get(AS_CHAR[b], -1) for b in range(256)]
        self.final = [self.vocab.get(AS_CHAR[b] + self.suffix, -1) for b in range(256)]
        self.code, self.kind = ("H", np.uint16) if len(self.strings) <= 1 << 16 else ("I", np.uint32)
        self.memo = UnitMemo(self.chunks, self.kind)
        self.pieces: dict[str, array] = {}

    def merge(self, piece: bytes) -> array:
        """The ids of one piece: always the pair of the lowest rank is merged next, the leftmost of equal rank first."""
        ids = [self.plain[b] for b in piece[:-1]]
        ids.append(self.final[piece[-1]])
        ids = [x for x in ids if x >= 0]
        n = len(ids)
        before, after, merges = list(range(-1, n - 1)), [*range(1, n), -1], self.merges
        queue = []
        for k in range(n - 1):
            got = merges.get((ids[k], ids[k + 1]))
            if got:
                queue.append((got[0], k, got[1], ids[k], ids[k + 1]))
        heapq.heapify(queue)
        while queue:
            _, k, merged, left, right = heapq.heappop(queue)
            j = after[k]
            if ids[k] != left or j < 0 or ids[j] != right:
                continue  # stale: one of the two symbols has been merged since
            ids[k], ids[j] = merged, -1
            j = after[k] = after[j]
            if j >= 0:
                before[j] = k
                got = merges.get((merged, ids[j]))
                if got:
                    heapq.heappush(queue, (got[0], k, got[1], merged, ids[j]))
            i = before[k]
            if i >= 0:
                got = merges.get((ids[i], merged))
                if got:
                    heapq.heappush(queue, (got[0], i, got[1], ids[i], merged))
        return array(self.code, [x for x in ids if x >= 0])

    def encode(self, text: str) -> array:
        """The ids of a text: what is between added tokens is normalised and split into pieces."""
        out = array(self.code)
        for part in self.split_added.split(text) if self.split_added else (text,):
            if part in self.added:
                out.append(self.added[part])
            else:
                out += self.plain_ids(part)
        return out

    def plain_ids(self, part: str) -> array:
        """The ids of text without added tokens that ends where white space begins."""
        out = array(self.code)
        if not part.isascii():
            part = unicodedata.normalize("NFC", part)
        for piece in self.pattern.findall(lower(part)):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.merge(piece.encode())
                if len(self.pieces) > 300_000:
                    self.pieces.clear()
                self.pieces[piece] = ids
            out += ids
        return out

    def decode(self, ids) -> str:
        return " ".join([self.strings[k] for k in ids])

    def chunks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        flat, count = array(self.code), array("l")
        for t in texts:
            got = self.plain_ids(t.decode("utf-8", "replace"))
            flat += got
            count.append(len(got))
        return np.frombuffer(flat, self.kind) if flat else np.zeros(0, self.kind), np.frombuffer(count, np.int64)

    def texts(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts one after another, and how many each has; every distinct word is merged once."""
        n, raw = len(off) - 1, buf.tobytes()
        odd = np.zeros(n, bool)
        odd[np.searchsorted(off, [m.start() for m in self.unusual.finditer(raw, overlapped=True)], side="right") - 1] = True
        start, end, doc = K.words(buf, off)
        live = ~odd[doc]
        start, end, doc = start[live], end[live], doc[live]
        ids, length = self.memo.ids(buf, start, end)
        count = np.bincount(doc, length, n).astype(np.int64)
        if odd.any():
            own = {int(k): np.array(self.encode(raw[off[k] : off[k + 1]].decode("utf-8", "replace")), self.kind) for k in np.flatnonzero(odd)}
            at = np.cumsum(count) - count
            ids = np.concatenate([own[k] if k in own else ids[at[k] : at[k] + count[k]] for k in range(n)])
            for k, x in own.items():
                count[k] = len(x)
        return ids, count


@lru_cache(2)
def bpe(path: str) -> Bpe:
    """One for each worker process."""
    return Bpe(path)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text; with `keep` also ids and decoded themselves. No shuffle."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * keep

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = bpe(path)
        doc_ids = batch.column("doc_id")
        width = np.array([len(x) + 1 for x in model.raw])
        joined = np.frombuffer(b"".join(x + b" " for x in model.raw), np.uint8)
        place = np.cumsum(width) - width
        for lo, hi, buf, off in K.text_chunks(batch.column("text")):
            ids, count = model.texts(buf, off)
            ends = np.cumsum(count)
            shown = K.gather(joined, place[ids], width[ids]).tobytes()  # every token with a space after it
            at = np.concatenate([[0], np.cumsum(width[ids])])[np.concatenate([[0], ends])]
            wide = memoryview(ids.astype("<u4").tobytes())
            bounds = list(zip((ends - count).tolist(), ends.tolist(), strict=True))
            text = [shown[s : max(s, e - 1)] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            out = {"doc_id": doc_ids.slice(lo, hi - lo), "n_tokens": count, "ids_sha256": [hashlib.sha256(wide[4 * s : 4 * e]).hexdigest() for s, e in bounds], "decoded_sha256": [hashlib.sha256(t).hexdigest() for t in text]}
            if keep:
                out |= {"ids": pa.array([ids[s:e].astype(np.int32) for s, e in bounds], pa.list_(pa.int32())), "decoded": [t.decode() for t in text]}
            yield pa.RecordBatch.from_pydict(out)

    return map_batches(ids_and_texts(docs, id_col, text_col), run, schema)
