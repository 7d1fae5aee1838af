"""Content-defined positions of byte strings: the anchor of each window of `WIDTH` bytes.

A window's anchor is the place of the least fingerprint of its `GRAM`-byte strings, the leftmost of equal ones. It depends
on the window's bytes alone, so equal windows have anchors at equal distances. There is about one anchor to
(WIDTH - GRAM + 2) / 2 bytes.
"""

from __future__ import annotations

import numpy as np

from . import kernels as K

WIDTH, GRAM = 200, 40
#: Bits of a chunk's places; fingerprints are compared by the other bits.
PLACE = 28


def anchors(buf: np.ndarray, off: np.ndarray, run: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window start, last window start) of the anchors of all windows that lie in one text."""
    if len(buf) >= 1 << PLACE:
        raise ValueError("a text of 256 MB or more")
    n = len(buf) - width + 1
    none = np.zeros(0, np.int64)
    if n <= 0 or len(off) < 2:
        return none, none, none
    m = len(buf) - gram + 1
    h = (run[gram:] - run[:-gram]) * K.powers(len(buf))[1][:m]
    h *= np.uint64(0x9E3779B97F4A7C15)  # the high bits, which decide, take in every byte
    h &= ~np.uint64((1 << PLACE) - 1)
    h |= np.arange(m, dtype=np.uint64)
    span, have = width - gram + 1, 1
    while have < span:  # least of `have` places, doubled until it spans a window
        step = min(have, span - have)
        h = np.minimum(h[: len(h) - step], h[step:])
        have += step
    least = (h & np.uint64((1 << PLACE) - 1)).astype(np.int64)
    for e in off[1:].tolist():  # windows that reach into the next text
        least[max(0, e - width + 1) : e] = -1
    new = np.ones(n, bool)
    np.not_equal(least[1:], least[:-1], out=new[1:])
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1
    inside = least[first] >= 0
    return least[first][inside], first[inside], last[inside]
