"""Benchmark decontamination: a prefix-filtered containment join of item windows and documents.

A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
A window is contained in a document where its words stand consecutively. Exact containment allows no
missing shingle, so of a window's shingles (``shingle`` words each) ordered by rarity in the documents a
prefix of one, the rarest, is necessary: documents are joined on that shingle only, and a match is a
candidate with a known place for the whole window. Candidates must lie inside the document (positional and
length bound) and are then compared word for word.

Item windows go to the executors in blocks of a checked size (``block_windows``); each block is one more
pass over the documents without a shuffle, so a benchmark of any size is joined whole.

Cases: a null or empty text has no words and no hits; an item without words has no window; repeated items
all count; repeated documents give a row each; an empty benchmark gives no hits; other columns are carried, those
named like a computed one replaced (``decontaminate`` returns every column as it was).
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import Words, released_memory
from tallyframe.llm.shared import bounded_batches, packed, unpacked, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spans are word ranges [start, stop) of one window's occurrence, with the bytes [begin, end) that they stand in.
SPAN = T.StructType([*[T.StructField(n, T.LongType()) for n in ("start", "stop", "begin", "end")], T.StructField("item_id", T.StringType())])


def words_column(text) -> F.Column:
    """The words of a text column: A-Z lower-cased, split at ASCII other than letters and digits; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """(item_id string, words array<string>): the windows of every item."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), words_column(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))))
    return words.select("item_id", "w", starts.alias("i")).select("item_id", F.slice("w", F.col("i"), F.lit(window)).alias("words")).distinct()


class Block:
    """Some windows with their items, and the hashes of their shingles."""

    def __init__(self, rows: list[tuple[str, list[str]]], shingle: int):
        items: dict[tuple[str, ...], list[str]] = defaultdict(list)
        for item, words in rows:
            items[tuple(words)].append(item)
        self.windows = sorted(items)
        self.items = [sorted(items[w]) for w in self.windows]
        self.texts = [" ".join(w).encode() for w in self.windows]
        found = Words(self.texts)
        self.size = found.counts()
        self.widths = np.minimum(self.size, shingle)
        window, offset, value = [], [], []
        for width in np.unique(self.widths).tolist():
            at, h = found.shingles(width)
            own = found.doc[at]
            use = self.widths[own] == width
            window.append(own[use])
            offset.append((at - found.first[own])[use])
            value.append(h[use])
        self.window, self.offset, self.value = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (window, offset, value))
        self.value = self.value.astype(np.uint64)
        self.known = np.unique(self.value)

    def prefix(self, frequency: np.ndarray) -> "Prefix":
        """frequency: in how many documents each hash of ``known`` occurs."""
        rarity = frequency[np.searchsorted(self.known, self.value)]
        order = np.lexsort((self.offset, self.value, rarity, self.window))
        first = order[np.unique(self.window[order], return_index=True)[1]]
        return Prefix(self, first)


class Prefix:
    """For each window its rarest shingle: what documents are joined on."""

    def __init__(self, block: Block, chosen: np.ndarray):
        by = defaultdict(list)
        for k in chosen.tolist():
            by[int(block.value[k])].append((int(block.window[k]), int(block.offset[k])))
        self.keys = np.array(sorted(by), np.uint64)
        self.targets = [by[int(k)] for k in self.keys]
        self.widths = np.unique(block.widths).tolist()
        self.texts, self.size, self.items = block.texts, block.size.tolist(), block.items

    def spans(self, texts: list[bytes], finder: "Finder") -> tuple[Words, dict[int, list[dict]]]:
        words, out = Words(texts), defaultdict(list)
        for width in self.widths:
            at, h = words.shingles(width)
            for i, k in zip(*finder(at, h)):
                doc = int(words.doc[i])
                low, high = int(words.first[doc]), int(words.first[doc + 1])
                for window, offset in self.targets[k]:
                    start, n = i - offset, self.size[window]
                    if start >= low and start + n <= high and words.text_of(start, n) == self.texts[window]:
                        place = {"start": start - low, "stop": start - low + n, "begin": int(words.start[start] - words.at[doc]), "end": int(words.end[start + n - 1] - words.at[doc])}
                        out[doc] += [{**place, "item_id": item} for item in self.items[window]]
        return words, out


class Finder:
    """Looks hashes up in a sorted array, most misses by one table of bits."""

    def __init__(self, keys: np.ndarray, log2: int = 20):
        self.keys, self.shift = keys, np.uint64(64 - log2)
        self.seen = np.zeros(1 << log2, bool)
        self.seen[keys >> self.shift] = True

    def __call__(self, at: np.ndarray, h: np.ndarray) -> tuple[list[int], list[int]]:
        if not len(self.keys):
            return [], []
        near = np.flatnonzero(self.seen[h >> self.shift])
        k = np.minimum(np.searchsorted(self.keys, h[near]), len(self.keys) - 1)
        same = self.keys[k] == h[near]
        return at[near[same]].tolist(), k[same].tolist()


def document_frequency(docs: DataFrame, text_col: str, known: np.ndarray, widths: list[int]) -> np.ndarray:
    """In how many of all documents each known shingle hash occurs."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def work(batches):
        from tallyframe.llm.bytewords import sub_batches

        keys = shared.value
        finder, n = Finder(keys), np.zeros(len(keys), np.int64)
        for batch in batches:
            for _, texts in sub_batches(batch.column(0)):
                words = Words(texts)
                for width in widths:
                    at, k = finder(*words.shingles(width))
                    if at:
                        pairs = np.unique(np.stack([words.doc[at], np.array(k)]), axis=1)
                        n += np.bincount(pairs[1], minlength=len(keys))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["k", "n"])
        released_memory()

    out = np.zeros(len(known), np.int64)
    for k, n in docs.select(text_col).mapInArrow(work, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[k] = n
    return out


def find_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, shingle: int = 5, block_windows: int = 200_000, out: str = "spans") -> DataFrame:
    """docs with ``n_words`` and ``out``: array of ``SPAN``, every occurrence of every window.

    The driver holds one block of windows and its shingle counts at a time: ``block_windows`` windows on average.
    """
    spark = docs.sparkSession
    found = item_windows(items, item_id, item_text, window)
    blocks = max(1, -(-found.count() // block_windows))
    fields = [T.StructField("n_words", T.LongType()), T.StructField(out, T.ArrayType(SPAN))]
    parts, result = [], docs
    for b in range(blocks):
        rows = found.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b) if blocks > 1 else found
        block = Block([(r[0], r[1]) for r in rows.collect()], shingle)
        prefix = block.prefix(document_frequency(docs, text_col, block.known, np.unique(block.widths).tolist()))
        shared = spark.sparkContext.broadcast(prefix)

        def factory(shared=shared):
            prefix = shared.value
            finder = Finder(prefix.keys)

            def compute(texts):
                words, hits = prefix.spans(texts, finder)
                return words.counts().tolist(), [hits.get(d, []) for d in range(len(texts))]

            return compute

        name = f"__spans_{b}" if blocks > 1 else out
        parts.append(name)
        result = with_text_columns(result, text_col, [fields[0], T.StructField(name, fields[1].dataType)], factory)
    if blocks > 1:
        result = result.withColumn(out, F.flatten(F.array(*parts))).drop(*parts)
    return result


def hit_words(spans) -> F.Column:
    """How many words the spans cover together."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    return F.aggregate(
        F.array_distinct(ordered),
        zero,
        lambda a, s: F.struct((a["n"] + F.greatest(s["stop"] - F.greatest(s["start"], a["upto"]), F.lit(0).cast("long"))).alias("n"), F.greatest(a["upto"], s["stop"]).alias("upto")),
        lambda a: a["n"],
    )


def judged(docs: DataFrame, items: DataFrame, share: float = 0.05, **options) -> DataFrame:
    """find_spans with n_hit, item_ids (sorted) and contaminated: some word hit, and at least ``share`` of all."""
    found = find_spans(docs, items, **options)
    found = found.withColumn("n_hit", hit_words(F.col("spans"))).withColumn("item_ids", F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))))
    least = Fraction(share).limit_denominator(1_000_000)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * F.lit(least.denominator) >= F.col("n_words") * F.lit(least.numerator)))


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that are not contaminated, with the columns of docs, whatever these are called."""
    kept = judged(packed(docs, text_col), items, **options).where(~F.col("contaminated"))
    return unpacked(kept, docs.columns, text_col)


def _cut_from(text: str, whole: str) -> F.Column:
    """Whether the text's bytes stand in the whole text in their order."""

    def fits(part: str, of: str) -> bool:
        of, at = of.encode(), 0
        for byte in part.encode():
            at = of.find(byte, at) + 1
            if not at:
                return False
        return True

    @F.pandas_udf("boolean")
    def each(parts: pd.Series, wholes: pd.Series) -> pd.Series:
        return pd.Series([fits(*x) for x in zip(parts, wholes)], dtype=bool)

    return each(text, whole)


def clean_before(docs: DataFrame, before: DataFrame, items: DataFrame, named: list[str], text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that are not contaminated in ``before``, whose texts they hold, perhaps with bytes cut out.

    named: columns of both that tell which row of before a row comes from; nulls are equal. Where rows of before of one
    name differ in their verdict, a row comes from the text that it equals, else from one that it can be cut from (from
    several: a clean one); only these rows are compared text by text. A row that before doesn't have stays.
    """
    name = F.struct(F.lit(0).alias("__"), *[F.col(f"__row.`{c}`").alias(c) for c in named]).alias("__name")
    found = judged(packed(before, text_col), items, **options).select(name, F.coalesce("text", F.lit("")).alias("whole"), "contaminated")
    verdicts = found.groupBy("__name").agg(F.bool_and("contaminated").alias("all"), F.bool_or("contaminated").alias("any"))
    verdicts = written(verdicts.where("any").select("__name", "all"), "contaminated")
    rows = packed(docs, text_col).withColumn("__name", name)
    kept = rows.join(verdicts.where("all").select("__name"), "__name", "left_anti")
    mixed = verdicts.where("NOT all").select("__name")
    if not mixed.isEmpty():
        own = F.coalesce("text", F.lit(""))
        cut = kept.join(mixed, "__name", "left_semi").select("__name", own.alias("own")).distinct()
        pairs = cut.join(found.join(mixed, "__name", "left_semi").distinct(), "__name").where(F.octet_length("own") <= F.octet_length("whole"))
        pairs = pairs.where(_cut_from("own", "whole")).groupBy("__name", "own").agg(F.min(F.struct(F.col("own") != F.col("whole"), "contaminated")).alias("of"))
        gone = written(pairs.where("of.contaminated").select("__name", "own"), "contaminated")
        kept = kept.withColumn("own", own).join(gone, ["__name", "own"], "left_anti")
    return unpacked(kept, docs.columns, text_col)
