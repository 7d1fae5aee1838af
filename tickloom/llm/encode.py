"""Whole texts to ids of a byte-level BPE file of the tokenizers library, by distinct units.

A unit is a run of white space with the word after it. The file's pre-tokeniser never joins a word with the white space
after it and looks ahead only within a run, so units are encoded apart with the ids of the whole text. Texts that hold
white space beyond ASCII, ASCII separators or an added token are given to the library whole.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import regex

from . import kernels as K
from .memo import UnitMemo

UNUSUAL = rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|\xef\xbb\xbf"

#: The split of the byte-level pre-tokeniser, and the character that stands for each byte: fixed values of the file format.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
AS_CHAR = {b: chr(b) for b in SHOWN} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in SHOWN)}


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the units; they cover every byte."""
    space = K.SPACE[buf]
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[off[:-1][off[:-1] < len(buf)]] = True
    start = np.flatnonzero(first)
    return start, np.append(start[1:], len(buf)), np.searchsorted(off, start, side="right") - 1


class ByteEncoder:
    """`special`: whether strings of added tokens in a text get their ids, the library's default."""

    def __init__(self, path: str, special: bool = True):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.model = self.tokenizer.model
        added = (t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.unusual = regex.compile(b"|".join([UNUSUAL, *(regex.escape(t, special_only=True) for t in added)]))
        self.code, self.kind = ("H", np.uint16) if vocabulary_size(path) <= 1 << 16 else ("I", np.uint32)
        self.memo, self.pieces = UnitMemo(self.by_piece, self.kind), {}

    def by_piece(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Units through the library's BPE model, piece by piece: half the time of the library's whole path."""
        flat, count, pieces, split, tokenize = array(self.code), array("l"), self.pieces, PIECES.findall, self.model.tokenize
        if len(pieces) > 200_000:
            pieces.clear()
        for t in texts:
            before = len(flat)
            for piece in split(t.decode("utf-8", "replace")):
                got = pieces.get(piece)
                if got is None:
                    got = pieces[piece] = array(self.code, [x.id for x in tokenize(piece.encode().decode("latin-1").translate(AS_CHAR))])
                flat += got
            count.append(len(flat) - before)
        return np.frombuffer(flat, self.kind) if flat else np.zeros(0, self.kind), np.frombuffer(count, np.int64)

    def library(self, texts: list[bytes]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]

    def __call__(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        n = len(off) - 1
        raw = buf.tobytes()
        odd = np.zeros(n, bool)
        odd[np.searchsorted(off, [m.start() for m in self.unusual.finditer(raw, overlapped=True)], side="right") - 1] = True
        start, end, doc = units(buf, off)
        if odd.any():
            start, end, doc = (x[~odd[doc]] for x in (start, end, doc))
        ids, length = self.memo.ids(buf, start, end)
        count = np.bincount(doc, length, n).astype(np.int64)
        if odd.any():
            own = {int(k): np.array(x, self.kind) for k, x in zip(np.flatnonzero(odd), self.library([raw[off[k] : off[k + 1]] for k in np.flatnonzero(odd)]), strict=True)}
            at = np.cumsum(count) - count
            ids = np.concatenate([own[k] if k in own else ids[at[k] : at[k] + count[k]] for k in range(n)])
            for k, x in own.items():
                count[k] = len(x)
        return ids, count


@lru_cache(2)
def byte_encoder(path: str, special: bool = True) -> ByteEncoder:
    """One for each worker process, so that what it has learnt lasts from task to task."""
    return ByteEncoder(path, special)


def vocabulary_size(path: str) -> int:
    """One more than the largest id, added tokens included."""
    from tokenizers import Tokenizer

    return max(Tokenizer.from_file(path).get_vocab().values(), default=0) + 1
