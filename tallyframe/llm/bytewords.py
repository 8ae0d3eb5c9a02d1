"""Word and hash arithmetic on whole batches of UTF-8 texts, in numpy.

A batch of texts becomes one byte array with a zero byte after each text. A word is a maximal
run of bytes outside ``\\x00-\\x2F``, ``\\x3A-\\x60`` and ``\\x7B-\\x7F`` after lower-casing A-Z, which on
UTF-8 equals the character pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Hashes are 64 bits wide: a
polynomial over random byte values modulo 2**64, then a finaliser.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Byte -> lower-cased word byte, or 0 where the byte separates words.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)
#: The same for bytes.translate, with a space where the byte separates words.
FOLD_TABLE = bytes(int(x) or 32 for x in FOLD)
_RANDOM = np.random.default_rng(0x5EED)
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, U64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15 | 1
STEP = U64(0xD6E8FEB86659FD93)
#: Texts are handled together up to so many bytes; a longer text is handled alone.
BATCH_BYTES = 1 << 19


@lru_cache(maxsize=2)
def _powers(log2: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << log2
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n at least."""
    return _powers(max(20, int(n).bit_length()))


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of h over all 64."""
    h = h ^ (h >> U64(32))
    h = h * STEP
    h = h ^ (h >> U64(29))
    h = h * U64(0xBF58476D1CE4E5B9)
    return h ^ (h >> U64(32))


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: nothing to call
        return lambda _: 0


def released_memory() -> None:
    """Gives memory that a finished task has freed back to the system: a Python worker lives on for other tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def sub_batches(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as bytes), at most about ``limit`` bytes together; null counts as empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    raw = texts.cast(pa.large_binary()) if pa.types.is_large_string(texts.type) else texts.cast(pa.binary())
    sizes = np.nan_to_num(np.asarray(pa.compute.binary_length(raw).to_numpy(zero_copy_only=False), np.float64)).astype(np.int64)
    cuts, held = [0], 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            cuts.append(i)
            held = 0
        held += n + 1
    cuts.append(len(sizes))
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield a, [x or b"" for x in raw.slice(a, b - a).to_pylist()]


class Words:
    """The words of a list of texts.

    buffer, folded: the joined bytes, as they are and folded; at: where each text begins, with the end last;
    start, end: byte range of each word; doc: index of its text; first: index of each text's first word, with
    the number of words last; hash: of each folded word.
    """

    def __init__(self, texts: list[bytes]):
        joined = b"\0".join(texts) + b"\0"
        self.buffer = np.frombuffer(joined, np.uint8)
        self.at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) + 1 for x in texts], out=self.at[1:])
        self.folded = FOLD[self.buffer]
        edge = np.flatnonzero(np.diff((self.folded != 0).view(np.int8), prepend=np.int8(0)))
        self.start, self.end = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.start, self.at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        forward, inverse = powers(len(self.buffer))
        total = np.zeros(len(self.buffer) + 1, U64)
        np.cumsum(BYTE_VALUE[self.folded] * forward[: len(self.buffer)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start] + (self.end - self.start).astype(U64))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of each n consecutive words of one text."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        return join_hashes(self.hash, self.doc, n)

    def text_of(self, i: int, n: int) -> bytes:
        """The n folded words from word i on, joined by a space."""
        return b" ".join(self.folded[a:b].tobytes() for a, b in zip(self.start[i : i + n], self.end[i : i + n]))


def join_hashes(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    m = len(words) - n + 1
    h = np.full(m, n, U64)
    for j in range(n):
        h = h * STEP + words[j : j + m]
    at = np.flatnonzero(doc[:m] == doc[n - 1 :])
    return at, mix(h[at])


def fold_words(text: str | None) -> list[str]:
    """The words of one text; null has none."""
    return [x.decode() for x in (text or "").encode("utf-8", "surrogatepass").translate(FOLD_TABLE).split(b" ") if x]


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return h.view(np.int64)
