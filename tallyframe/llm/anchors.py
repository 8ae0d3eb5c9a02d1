"""Anchors: positions that any two equal strings of a given length choose alike.

Each window of ``length`` bytes chooses, of the ``gram``-byte strings inside it, the one with the least hash
(the leftmost of equals). Neighbouring windows mostly choose the same place, so the windows of a text fall
into runs with one anchor each; windows that hold equal bytes have their anchor at the same distance.
"""

from __future__ import annotations

import numpy as np

from tallyframe.llm.bytewords import BYTE_VALUE, STEP, U64, mix, powers


class Bytes:
    """Texts joined to one byte array (a zero byte after each) with hashes of any of its stretches."""

    def __init__(self, texts: list[bytes]):
        self.buffer = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        self.sizes = np.array([len(x) for x in texts], np.int64)
        self.at = np.zeros(len(texts), np.int64)
        np.cumsum(self.sizes[:-1] + 1, out=self.at[1:])
        forward, self.inverse = powers(len(self.buffer) + 1)
        self.total = np.zeros(len(self.buffer) + 1, U64)
        np.cumsum(BYTE_VALUE[self.buffer] * forward[: len(self.buffer)], out=self.total[1:])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix((self.total[stop] - self.total[start]) * self.inverse[start] + (stop - start).astype(U64))

    def grams(self, n: int) -> np.ndarray:
        """The hash of the n bytes from each place on, across texts too."""
        m = len(self.buffer) - n + 1
        if m <= 0:
            return np.zeros(0, U64)
        return mix((self.total[n:] - self.total[:m]) * self.inverse[:m] + U64(n))


def sliding_least(values: np.ndarray, n: int) -> np.ndarray:
    """The least of each n neighbours."""
    width, out = 1, values
    while 2 * width <= n:
        out = np.minimum(out[: len(out) - width], out[width:])
        width *= 2
    rest = n - width
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchor_runs(b: Bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, first, count, lead, gram hash, segment hash) of each run of windows with one anchor.

    first: where the run's first window starts in its text; count: how many windows it has; lead: how far
    the anchor lies after ``first``. The segment hash covers all bytes of the run's windows.
    """
    m = len(b.buffer) - length + 1
    none = np.zeros(0, np.int64)
    if m <= 0 or not (b.sizes >= length).any():
        return none, none, none, none, none.astype(U64), none.astype(U64)
    grams = b.grams(gram)
    place = np.arange(len(grams), dtype=U64)
    chosen = (sliding_least((grams & U64(0xFFFFFFFF00000000)) | place, length - gram + 1)[:m] & U64(0xFFFFFFFF)).astype(np.int64)
    # windows that lie inside a text
    change = np.zeros(m + 1, np.int32)
    use = np.flatnonzero(b.sizes >= length)
    np.add.at(change, b.at[use], 1)
    np.add.at(change, b.at[use] + b.sizes[use] - length + 1, -1)
    inside = np.cumsum(change[:m]) > 0
    new = inside.copy()
    new[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1]
    start = np.flatnonzero(new)
    stops = inside.copy()
    stops[:-1] &= (chosen[1:] != chosen[:-1]) | ~inside[1:]
    count = np.flatnonzero(stops) - start + 1
    anchor = chosen[start]
    text = np.searchsorted(b.at, start, "right") - 1
    lead = anchor - start
    segment = mix(b.hashes(start, start + count - 1 + length) * STEP + (lead * 4096 + count).astype(U64))
    return text, start - b.at[text], count, lead, grams[anchor], segment
