"""Near duplicates by DartMinHash: sparse weighted signatures, banded joining, exact verification.

Elements are the distinct shingles of five words (a text of fewer, but some, is one shingle), each of weight 1
however often it stands in the text: links are decided by the likeness of the sets, so signatures estimate that
same likeness. ``signatures`` takes any weights. The plane over an element, weight by rank, is cut into regions of dyadic weight
([0,1), [1,2), [2,4), ...); into each region darts are thrown at hashed, exponentially spaced ranks. A dart
counts if its weight lies below the element's; it has a hashed coordinate. Of the darts of all elements the
earliest at each of k coordinates is the signature, so two texts agree at a coordinate with the
probability of their weighted Jaccard likeness. Darts are thrown up to the rank where about k ln k + 2k of
them count, and further for texts that still have an empty coordinate; work thus hardly depends on weights.

Signatures are joined in bands. Equal texts are one text from the start. In each bucket of a band every text
is paired with the bucket's smallest id (a star, not all pairs); pairs are verified exactly (Jaccard of the
shingle sets); links become classes by alternating large and small stars. Buckets that still hold several
classes are compared again across classes, every pair: in buckets of up to ``small`` texts as rows of pairs; the
texts of larger ones by family (texts that such buckets connect) and length, in blocks whose shared shingles
are counted as matrix products, so that only links become rows. No pair inside a class is needed twice.

Cases: null counts as an empty text; texts without words are alike only if equal; repeated rows give a row
each; where ids are null or repeat, rows are told apart by id and text, and a class of null ids alone has a null
class_id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import STEP, U64, Words, mix
from tallyframe.llm.shared import bounded_batches, written
from tallyframe.llm.suffixdedup import _numbered

SHINGLE, BANDS, ROWS, THRESHOLD = 5, 24, 4, 0.8


def elements(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), sorted by text and hash."""
    words = Words(texts)
    at, h = words.shingles(n)
    doc = words.doc[at]
    counts = words.counts()
    for i in np.flatnonzero((counts > 0) & (counts < n)).tolist():
        k = int(counts[i])
        value = U64(k)
        for x in words.hash[words.first[i] : words.first[i + 1]]:
            value = value * STEP + x
        doc, h = np.append(doc, i), np.append(h, mix(np.array([value], U64)))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def _throw(doc, h, weight, limit, k, best_rank, best_dart):
    """Throws darts up to each text's rank limit and keeps the earliest of each coordinate."""
    top = 0
    while True:
        low, wide = (0.0, 1.0) if top == 0 else (2.0 ** (top - 1), 2.0 ** (top - 1))
        own = np.flatnonzero(weight > low)
        if not len(own):
            return
        rank = np.zeros(len(own))
        seed = mix(h[own] + U64((top + 1) * 0xA0761D6478BD642F & (1 << 64) - 1))
        j = 0
        while len(own):
            dart = mix(seed + U64((2 * j + 1) * 0xE7037ED1A0B428DB & (1 << 64) - 1))
            rank = rank - np.log(((dart >> U64(11)).astype(np.float64) + 1.0) / 2.0**53) / wide
            alive = rank < limit[doc[own]]
            own, rank, seed, dart = own[alive], rank[alive], seed[alive], dart[alive]
            more = mix(dart ^ U64(0x8EBC6AF09C88C6E3))
            hit = low + wide * ((more >> U64(32)).astype(np.float64) / 2.0**32) < weight[own]
            slot = doc[own[hit]] * k + (more[hit] & U64(0xFFFFFFFF)).astype(np.int64) % k
            r, d = rank[hit], dart[hit]
            np.minimum.at(best_rank, slot, r)
            won = best_rank[slot] == r
            best_dart[slot[won]] = d[won]
            j += 1
        top += 1


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n: int, k: int) -> np.ndarray:
    """n by k earliest darts; rows of texts without elements are 0."""
    best_rank, best_dart = np.full(n * k, np.inf), np.zeros(n * k, U64)
    total = np.bincount(doc, weight, n)
    limit = np.divide(k * np.log(k) + 2 * k, total, out=np.zeros(n), where=total > 0)
    due = total > 0
    while due.any():
        use = due[doc]
        _throw(doc[use], h[use], weight[use], limit, k, best_rank, best_dart)
        due &= np.isinf(best_rank).reshape(n, k).any(axis=1)
        limit = limit * 1.6
    return best_dart.reshape(n, k)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(sig), bands), U64)
    for b in range(bands):
        h = np.full(len(sig), b + 1, U64)
        for r in range(rows):
            h = h * STEP + sig[:, b * rows + r]
        out[:, b] = mix(h)
    return out


def signed_texts(df: DataFrame, text_col: str = "text", bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE) -> DataFrame:
    """df with ``bands``: array<long> of the signature's band hashes (empty without words), and ``n_shingles``."""

    def factory():
        def compute(texts):
            doc, h, _ = elements(texts, shingle)
            keys = band_keys(signatures(doc, h, np.ones(len(h)), len(texts), bands * rows), bands, rows).view(np.int64)
            n = np.bincount(doc, minlength=len(texts))
            keys = keys[n > 0]
            offsets = np.zeros(len(texts) + 1, np.int32)
            np.cumsum(np.where(n > 0, bands, 0), out=offsets[1:])
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())), pa.array(n, pa.int64())]

        return compute

    return with_text_columns(df, text_col, [T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("n_shingles", T.LongType())], factory)


def shingle_sets(df: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """df with ``shingles``: array<long>, the text's distinct shingle hashes."""

    def factory():
        def compute(texts):
            doc, h, _ = elements(texts, shingle)
            offsets = np.searchsorted(doc, np.arange(len(texts) + 1)).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(h.view(np.int64)))]

        return compute

    return with_text_columns(df, text_col, [T.StructField("shingles", T.ArrayType(T.LongType()))], factory)


def components(edges: DataFrame) -> DataFrame:
    """(id, class): the smallest id that each id of the edges (a, b) is connected to.

    Alternating large and small stars; each round works on the edges only and is written to the shared folder.
    """
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    now, mark = written(both, "edges"), None
    while True:
        sides = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = written(small, "edges")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            return now.groupBy("u").agg(F.min("v").alias("class")).withColumnRenamed("u", "id")
        mark = tuple(found)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that Jaccard likeness at least."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    n, m = F.size("x"), F.size("y")
    fits = F.least(n, m) >= F.lit(threshold) * F.greatest(n, m)
    same = F.size(F.array_intersect("x", "y"))
    return pairs.join(left, "a").join(right, "b").where(fits & (same >= F.lit(threshold) * (n + m - same) - F.lit(1e-9))).select("a", "b")


def _shared(left: tuple[np.ndarray, np.ndarray, int], right: tuple[np.ndarray, np.ndarray, int], width: int = 4096) -> np.ndarray:
    """How many values each text of the left has in common with each of the right; a side is (text, value, texts)."""
    both = np.intersect1d(left[1], right[1])
    out = np.zeros((left[2], right[2]), np.float32)
    sides = []
    for doc, value, n in (left, right):
        at = np.searchsorted(both, value)
        has = both[np.minimum(at, len(both) - 1)] == value if len(both) else np.zeros(len(value), bool)
        order = np.argsort(at[has], kind="stable")
        sides.append((doc[has][order], at[has][order], n))
    for low in range(0, len(both), width):
        dense = []
        for doc, at, n in sides:
            a, z = np.searchsorted(at, (low, low + width))
            m = np.zeros((n, min(width, len(both) - low)), np.float32)
            m[doc[a:z], at[a:z] - low] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _joining(pairs: np.ndarray, classes: np.ndarray) -> list[int]:
    """Indices of pairs of texts that join all classes which the pairs join, at most one less than the classes."""
    ends = np.sort(classes[pairs], axis=1)
    _, first = np.unique(ends, axis=0, return_index=True)
    up, out = {}, []

    def root(c):
        while (above := up.get(c, c)) != c:
            up[c] = up.get(above, above)
            c = above
        return c

    for k in first.tolist():
        a, b = root(int(ends[k, 0])), root(int(ends[k, 1]))
        if a != b:
            up[b] = a
            out.append(k)
    return out


def _block_links(threshold: float):
    """Links (a, b) across classes between the texts of blocks lo and hi, or of one block where these are the same."""

    def work(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        block, own = table["block"].to_numpy(), table["own"].to_numpy()
        classes = pa.compute.rank(table["class"], tiebreaker="dense").to_numpy().astype(np.int64)
        sets = table["shingles"].combine_chunks()
        sizes = pa.compute.list_value_length(sets).to_numpy(zero_copy_only=False).astype(np.int64)
        doc, value = np.repeat(np.arange(len(sizes)), sizes), sets.flatten().to_numpy()
        rows, sides = [], []
        for at in (table["lo"][0].as_py(), table["hi"][0].as_py()):
            has = block == at
            rows.append(np.flatnonzero(has))
            use = has[doc]
            sides.append(((np.cumsum(has) - 1)[doc[use]], value[use], len(rows[-1])))
        same = _shared(*sides)
        x, y = rows[0][:, None], rows[1][None, :]
        near = (same >= threshold * (sizes[x] + sizes[y] - same.astype(np.float64)) - 1e-9) & (classes[x] != classes[y]) & (own[x] | own[y])
        i, j = np.nonzero(near)
        pairs = np.stack([rows[0][i], rows[1][j]], axis=1)
        pairs = pairs[_joining(pairs, classes)]
        return pa.table({"a": table["id"].take(pa.array(pairs[:, 0])), "b": table["id"].take(pa.array(pairs[:, 1]))})

    return work


def _family_links(texts: DataFrame, sets: DataFrame, threshold: float, most: int = 256, most_shingles: int = 1 << 19) -> DataFrame:
    """Links (a, b) that join all classes of a family between which there is a near pair; texts has (family, class, id, n).

    A text stands in its length partition and in the next, as near texts lie in one or neighbouring partitions. In a
    partition the texts of the largest class meet the blocks of the others, and these meet all blocks.
    """
    wide = max(-math.log(threshold) * (1 + 1e-6), 1e-9)
    part = F.floor(F.log(F.col("n").cast("double")) / wide)
    placed = texts.withColumn("p", F.explode(F.array(part, part + 1))).withColumn("own", F.col("p") == part)
    by_class = placed.groupBy("family", "p", "class").agg(F.count("*").alias("c"), F.sum("n").alias("s"), F.max("own").alias("own"))
    top = by_class.groupBy("family", "p").agg(F.max(F.struct("c", "s", "class")).alias("t"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.max("own").alias("used"))
    blocks = lambda c, s: F.greatest(F.ceil(c / most), F.ceil(s / most_shingles))
    top = top.where(F.col("used") & (F.col("c") > F.col("t.c"))).select("family", "p", F.col("t.class").alias("largest"), blocks(F.col("t.c"), F.col("t.s")).alias("in_largest"), blocks(F.col("c") - F.col("t.c"), F.col("s") - F.col("t.s")).alias("others"))
    met = placed.join(top, ["family", "p"])
    first = F.col("class") == F.col("largest")
    at = F.when(first, F.col("others") + F.pmod(F.xxhash64("id"), F.col("in_largest"))).otherwise(F.pmod(F.xxhash64("id"), F.col("others")))
    met = met.withColumn("block", at).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(first, F.col("others")).otherwise(F.col("others") + F.col("in_largest")) - 1)))
    met = met.select("family", "p", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "id", "class", "block", "own").join(sets, "id")
    bounded_batches(texts.sparkSession)
    kind = dict(texts.dtypes)["id"]
    return met.groupBy("family", "p", "lo", "hi").applyInArrow(_block_links(threshold), f"a {kind}, b {kind}")


def _plain_ids(df: DataFrame, id_col: str) -> bool:
    """Whether no id is null and none repeats."""
    return df.groupBy(F.col(id_col).alias("k")).agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL").isEmpty()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, shingle: int = SHINGLE, small: int = 48) -> DataFrame:
    """(doc_id, class_id): texts of a class are linked by pairs that are equal or near; class_id is its smallest id."""
    if not _plain_ids(df, id_col):
        numbered, docs = _numbered(df.select(F.col(id_col).alias("__of"), F.col(text_col).alias("__own")), "__of", "__own")
        found = near_duplicates(docs, "uid", "text", threshold, bands, rows, shingle, small)
        found = written(numbered.select("uid", F.col("__of").alias("of")).join(found, "uid").select("of", "class_id"), "found")
        least = found.groupBy("class_id").agg(F.min("of").alias("least"))
        return found.join(least, "class_id").select(F.col("of").alias(id_col), F.col("least").alias("class_id"))
    own = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = own.withColumn("same", F.unhex(F.md5("text")))
    signed = written(signed_texts(keyed, "text", bands, rows, shingle).select("id", "same", "bands", "n_shingles"), "signed")
    texts = signed.groupBy("same").agg(F.min("id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
    texts = written(texts, "texts")
    rows_of = texts.select(F.col("rep").alias("id"), "n", F.explode("bands").alias("key"))
    buckets = rows_of.groupBy("key").agg(F.min("id").alias("b"), F.count("*").alias("members")).where("members > 1")
    placed = written(rows_of.join(buckets, "key").select("key", "members", "id", "n", "b"), "buckets")
    pairs = written(placed.where("id <> b").select(F.col("id").alias("a"), "b").distinct(), "pairs")
    members = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # merge: how many texts have a candidate grows with the input, so they are not broadcast at any size
    sets = written(shingle_sets(own.join(members.hint("merge"), "id", "left_semi"), "text", shingle).select("id", "shingles").groupBy("id").agg(F.first("shingles").alias("shingles")), "sets")
    links = written(_verified(pairs, sets, threshold), "links")
    classes = components(links)

    # buckets that still hold several classes
    labelled = placed.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    mixed = labelled.groupBy("key").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).where("c0 <> c1").select("key")
    rest = written(labelled.join(mixed, "key", "left_semi"), "mixed")
    low = rest.where(F.col("members") <= small)
    across = low.alias("p").join(low.alias("q"), (F.col("p.key") == F.col("q.key")) & (F.col("p.class") < F.col("q.class"))).select(F.col("p.id").alias("a"), F.col("q.id").alias("b"))
    high = rest.where(F.col("members") > small)
    again = across.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).distinct()
    again = again.join(pairs, ["a", "b"], "left_anti")
    more = _verified(again, sets, threshold)
    if not high.isEmpty():
        families = components(high.select(F.col("id").alias("a"), "b")).select("id", F.col("class").alias("family"))
        texts_of = high.select("id", "class", "n").distinct().join(families, "id", "left").withColumn("family", F.coalesce("family", "id"))
        more = more.unionByName(_family_links(texts_of, sets, threshold))
    more = written(more, "links")
    if not more.isEmpty():
        classes = components(links.unionByName(more))
    final = texts.join(classes, texts["rep"] == classes["id"], "left").select("same", F.coalesce("class", "rep").alias("class_id"))
    return signed.select("id", "same").join(final, "same").select(F.col("id").alias(id_col), "class_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The first row of each class of df, with df's columns; a null id comes first, and of rows of one id the least md5 of the text."""
    if _plain_ids(df, id_col):
        classes = near_duplicates(df, id_col, text_col, **options).where(F.col(id_col) == F.col("class_id")).select(F.col(id_col)).distinct()
        return df.join(classes, id_col, "left_semi").select(*df.columns)
    own, docs = _numbered(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"), F.col(id_col).alias("__of"), F.col(text_col).alias("__own")), "__of", "__own")
    first = near_duplicates(docs, "uid", "text", **options).where("uid = class_id").select("uid").distinct()
    return own.join(first, "uid", "left_semi").select("uid", "__row").dropDuplicates(["uid"]).select("__row.*")
