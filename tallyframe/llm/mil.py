"""Quality by attention-based multiple-instance learning: a document is a bag of passages.

A passage is ``PASSAGE`` consecutive words with what stands between them; every one is encoded: shares of byte
classes, and of repeated, short, long and capital words, go through a layer to ``HIDDEN`` numbers. Gated
attention, tanh(hV) * sigmoid(hU) . w, weighs the passages of a document against each other; the weighted sum of
their encodings is scored. Weights are learned from document labels alone, by Adam on the logistic loss.

Fitting takes a bounded sample (``labelled.sample``) on the driver; the model is a few thousand numbers.
Scoring reads whole texts in one pass without a shuffle.

Cases: a null or empty text is one passage without words; a sample without both labels gives a constant score;
repeated rows score alike; extra columns are carried, one named ``score`` or ``attention`` is replaced.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import U64, Words, mix

PASSAGE, HIDDEN, GATE = 48, 24, 16
#: Bytes that each make a class of their own.
_SINGLE = b" \n\t.,;:!?|%#$&*@/\\_-=+~^'\"`"
_CLASS = np.zeros(256, np.int64)
for _k, _b in enumerate(_SINGLE):
    _CLASS[_b] = _k + 1
_PLAIN = len(_SINGLE) + 1
_CLASS[np.arange(65, 91)], _CLASS[np.arange(97, 123)], _CLASS[np.arange(48, 58)], _CLASS[np.arange(128, 256)] = _PLAIN, _PLAIN + 1, _PLAIN + 2, _PLAIN + 3
for _b in b"()[]{}<>":
    _CLASS[_b] = _PLAIN + 4
CLASSES = _PLAIN + 5


def passages(texts: list[bytes], size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """(text of each passage, features of each passage); every text has one passage at least."""
    words = Words(texts)
    counts = words.counts()
    per = np.maximum(1, (counts + size // 2) // size)
    doc = np.repeat(np.arange(len(texts)), per)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    first_word = words.first[doc] + nth * size
    n = len(doc)
    # bytes: a passage reaches to the next one's first word, the first from the text's start
    begin = words.at[doc].copy()
    later = nth > 0
    begin[later] = words.start[first_word[later]]
    lengths = np.diff(np.append(begin, words.at[-1]))
    owner = np.repeat(np.arange(n), lengths)
    shares = np.bincount(owner * CLASSES + _CLASS[words.buffer], minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float64)
    shares[:, 0] -= np.bincount(owner[words.at[1:] - 1], minlength=n)  # the zero byte after a text
    shares /= np.maximum(shares.sum(1, keepdims=True), 1)
    # words
    last_word = np.append(first_word[1:], len(words.hash))
    many = np.maximum(last_word - first_word, 0)
    of = np.repeat(np.arange(n), many)
    long = (words.end - words.start).astype(np.float64)
    own = np.maximum(many, 1)
    mean = np.bincount(of, long, n) / own
    spread = np.sqrt(np.maximum(np.bincount(of, long**2, n) / own - mean**2, 0))
    keyed = mix(words.hash + of.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    again = np.zeros(len(keyed), bool)
    again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    same = np.zeros(len(keyed), bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (of[1:] == of[:-1])
    whole = mix(words.hash + words.doc.astype(U64) * U64(0xD1342543DE82EF95))
    order = np.argsort(whole, kind="stable")  # a word is new where it first stands
    twice = np.zeros(len(whole), bool)
    twice[order[1:]] = whole[order[1:]] == whole[order[:-1]]
    capital = (words.buffer[words.start] >= 65) & (words.buffer[words.start] <= 90)
    shouted = capital & (words.buffer[np.maximum(words.end - 1, 0)] >= 65) & (words.buffer[np.maximum(words.end - 1, 0)] <= 90) & (long > 1)
    gaps = np.bincount(owner, words.folded == 0, n) / np.maximum(many, 1)
    per_word = [np.bincount(of, x, n) / own for x in (again, same, twice, capital, shouted, long <= 2, long >= 8, long >= 14)]
    more = [np.log1p(many), mean, spread, np.minimum(gaps, 20), np.log1p(counts[doc]), many == 0, *per_word]
    return doc, np.column_stack([np.sqrt(np.maximum(shares, 0)), *more])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """Encoder, gated attention and scorer; ``steps`` of Adam over ``batch`` documents each."""

    def __init__(self, features: int, seed: int = 11):
        r = np.random.default_rng(seed)
        init = lambda *shape: r.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.p = {"W": init(features, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, GATE), "U": init(HIDDEN, GATE), "w": init(GATE), "c": init(HIDDEN), "d": np.zeros(1)}

    def _forward(self, x: np.ndarray, first: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        e = np.exp(e - np.maximum.reduceat(e, first)[of])
        a = e / np.add.reduceat(e, first)[of]
        z = np.add.reduceat(a[:, None] * h, first)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": z @ p["c"] + p["d"][0]}

    def _gradient(self, x, first, of, y, decay) -> dict[str, np.ndarray]:
        p, f = self.p, self._forward(x, first, of)
        dy = (_sigmoid(f["y"]) - y) / len(y)
        dz = dy[:, None] * p["c"]
        da = (dz[of] * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, first)[of])
        dg = de[:, None] * p["w"]
        dt, ds = dg * f["s"] * (1 - f["t"] ** 2), dg * f["t"] * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz[of] + dt @ p["V"].T + ds @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        out = {"W": x.T @ dpre, "b": dpre.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de, "c": f["z"].T @ dy, "d": np.array([dy.sum()])}
        return {k: v + decay * p[k] for k, v in out.items()}

    def fit(self, doc: np.ndarray, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 256, rate: float = 0.01, decay: float = 2e-4, seed: int = 11) -> "Model":
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        starts = np.searchsorted(doc, np.arange(len(y) + 1))
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(u) for k, u in self.p.items()}
        for step in range(1, steps + 1):
            chosen = r.choice(len(y), min(batch, len(y)), replace=False)
            n = starts[chosen + 1] - starts[chosen]
            first = np.cumsum(n) - n
            of = np.repeat(np.arange(len(chosen)), n)
            rows = np.arange(n.sum()) - first[of] + starts[chosen][of]
            g = self._gradient(x[rows], first, of, y[chosen], decay)
            now = rate * (1 - step / (steps + 1)) ** 0.5
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                self.p[k] = self.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def score(self, doc: np.ndarray, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(score of each of n texts, attention weight of each passage)."""
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        f = self._forward(x, np.searchsorted(doc, np.arange(n)), doc)
        return _sigmoid(f["y"]), f["a"]


class Constant:
    def __init__(self, value: float):
        self.value = value

    def score(self, doc, x, n):
        return np.full(n, self.value), np.ones(len(doc)) / np.bincount(doc, minlength=n)[doc]


def fitted(rows: list[tuple[int, bytes, int]], **options) -> Model | Constant:
    """A model of (id, text, label) rows; a constant if they don't have both labels."""
    y = np.array([k for _, _, k in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return Constant(float(y[0]) if len(y) else 0.5)
    docs, features, before, held, size = [], [], 0, [], 0
    for k, (_, text, _) in enumerate(rows):
        held.append(text)
        size += len(text)
        if size > 1 << 19 or k + 1 == len(rows):
            doc, x = passages(held)
            docs.append(doc + before)
            features.append(x.astype(np.float32))
            before, held, size = k + 1, [], 0
    x = np.concatenate(features)
    return Model(x.shape[1]).fit(np.concatenate(docs), x, y, **options)


FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("attention", T.ArrayType(T.DoubleType()))]


def score_quality(df: DataFrame, model: Model | Constant, text_col: str = "text", attention: bool = True) -> DataFrame:
    """df with ``score`` (0 to 1, likelihood of label 1) and ``attention``, the weight of each passage."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = FIELDS if attention else FIELDS[:1]

    def factory():
        own = shared.value

        def compute(texts):
            doc, x = passages(texts)
            score, weight = own.score(doc, x, len(texts))
            if not attention:
                return [score.tolist()]
            return score.tolist(), [w.tolist() for w in np.split(weight, np.searchsorted(doc, np.arange(1, len(texts))))]

        return compute

    return with_text_columns(df, text_col, fields, factory)
