"""Toxicity by compression distance: window lengths under a toxic and an ordinary zstandard dictionary.

The ordinary dictionary holds the words that ordinary labelled texts use most. The toxic one holds the same, and
before it the stretches at the starts of words that toxic texts share and ordinary ones lack: those of the
highest likelihood ratio, as often as a dictionary trainer would take frequent ones. A window is ``WINDOW``
folded words. What the toxic dictionary saves on it, over the ordinary one, is its distance; matches
are six bytes or more, so chance ones are rare. A document is judged by its windows' distances (the largest,
the mean of all and of the top three, the shares and number beyond 2, 3 and 4 bytes), whose weights, and so the
threshold, are calibrated by logistic regression on labelled texts that the dictionaries have not seen.

Fitting takes a bounded sample (``labelled.sample``) on the driver, one half for the dictionaries, the other for
calibration. Scoring reads whole texts in one pass without a shuffle.

Cases: a null or empty text is one window without words; a sample without both labels gives a constant score;
repeated rows score alike; extra columns are carried, ``score`` and ``top_distance`` are replaced.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import FOLD_TABLE

WINDOW, TOXIC_BYTES, BASE_BYTES, MIN_MATCH = 8, 1024, 2048, 6
LEAST_RATIO, LEAST_TEXTS = 8.0, 4
#: Bytes of a word beyond which it counts as several, so that a window never pushes the dictionary out of the compressor's reach.
LONG_WORD = 40


def _words(text: bytes) -> list[bytes]:
    words = text.translate(FOLD_TABLE).split()
    if len(text) > LONG_WORD and words and len(max(words, key=len)) > LONG_WORD:
        return [w[a : a + LONG_WORD] for w in words for a in range(0, len(w), LONG_WORD)]
    return words


def _starts(words: list[bytes]) -> set[bytes]:
    """The beginnings of words, five bytes or more, with the space before and the one after a whole word."""
    out = set()
    for w in set(words):
        b = b" " + w + b" "
        out.update(b[:n] for n in range(5, len(b) + 1))
    return out


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes], toxic_bytes: int = TOXIC_BYTES, base_bytes: int = BASE_BYTES) -> tuple[bytes, bytes]:
    """(toxic dictionary, ordinary dictionary) as raw content."""
    hits, misses, common = Counter(), Counter(), Counter()
    for t in toxic:
        hits.update(_starts(_words(t)))
    seen = {k for k, n in hits.items() if n >= LEAST_TEXTS}
    for t in ordinary:
        w = _words(t)
        common.update(w)
        misses.update(_starts(w) & seen)
    n, m = len(toxic), len(ordinary)

    def likelihood(k: int, size: int, p: float) -> float:
        return k * math.log(max(p, 1e-12)) + (size - k) * math.log(max(1 - p, 1e-12))

    ranked = []
    for k in seen:
        a, b = hits[k], misses[k]
        if a / n > b / max(m, 1):
            p = (a + b) / (n + m)
            ranked.append((likelihood(a, n, a / n) + likelihood(b, m, b / max(m, 1)) - likelihood(a, n, p) - likelihood(b, m, p), k))
    chosen: list[bytes] = []
    for ratio, k in sorted(ranked, key=lambda x: (-x[0], x[1])):
        if ratio < LEAST_RATIO or sum(map(len, chosen)) > toxic_bytes:
            break
        if not any(k in c for c in chosen):
            chosen.append(k)
    # what matters most stands last: near matches cost least
    usual = b"".join(b" " + w for w, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[: base_bytes // 2][::-1])[-base_bytes:] + b" "
    return b"".join(chosen[::-1]) + usual, usual


class Distance:
    """Window distances under two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes, window: int = WINDOW):
        import zstandard as zs

        plan = zs.ZstdCompressionParameters(window_log=13, chain_log=13, hash_log=13, search_log=5, min_match=MIN_MATCH, target_length=32, strategy=zs.STRATEGY_LAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
        make = lambda d: zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(d, dict_type=zs.DICT_TYPE_RAWCONTENT), compression_params=plan).compress
        self.toxic, self.ordinary, self.window = make(toxic), make(ordinary), window

    def distances(self, text: bytes) -> np.ndarray:
        words, n, toxic, ordinary = _words(text), self.window, self.toxic, self.ordinary
        windows = [b" " + b" ".join(words[a : a + n]) + b" " for a in range(0, max(len(words), 1), n)]
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows])

    def features(self, text: bytes) -> list[float]:
        d = np.sort(self.distances(text))[::-1]
        return [float(d[0]), float(d[:3].mean()), float(d.mean()), float((d >= 2).mean()), float((d >= 3).mean()), math.log1p(int((d >= 4).sum())), float((d >= 4).mean()), math.log(len(d))]


class Model:
    def __init__(self, toxic: bytes, ordinary: bytes, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray):
        self.toxic, self.ordinary, self.mean, self.scale, self.weights = toxic, ordinary, mean, scale, weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fitted(rows: list[tuple[int, bytes, int]], decay: float = 0.01) -> Model:
    """A model of (id, text, label) rows: dictionaries from every other row, calibration from the rest."""
    parts = rows[::2], rows[1::2]
    toxic, ordinary = train_dictionaries([t for _, t, k in parts[0] if k], [t for _, t, k in parts[0] if not k])
    y = np.array([k for _, _, k in parts[1]], np.float64)
    n = 8
    if not len(y) or y.min() == y.max():
        all_y = [k for _, _, k in rows]
        share = (sum(all_y) + 0.5) / (len(all_y) + 1)
        return Model(toxic, ordinary, np.zeros(n), np.ones(n), np.r_[np.zeros(n), math.log(share / (1 - share))])
    distance = Distance(toxic, ordinary)
    x = np.array([distance.features(t) for _, t, _ in parts[1]])
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z, w = np.c_[(x - mean) / scale, np.ones(len(x))], np.zeros(n + 1)
    ridge = np.r_[np.full(n, decay), 1e-9]
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        g = z.T @ (p - y) / len(y) + ridge * w
        w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + np.diag(ridge), g)
        if np.abs(g).max() < 1e-7:
            break
    return Model(toxic, ordinary, mean, scale, w)


FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("top_distance", T.DoubleType())]


def score_toxicity(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """df with ``score`` (0 to 1, likelihood of label 1) and ``top_distance``, bytes saved on the most toxic window."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def factory():
        own = shared.value
        distance = Distance(own.toxic, own.ordinary)

        def compute(texts):
            x = np.array([distance.features(t) for t in texts])
            return own.probability(x).tolist(), x[:, 0].tolist()

        return compute

    return with_text_columns(df, text_col, FIELDS, factory)
