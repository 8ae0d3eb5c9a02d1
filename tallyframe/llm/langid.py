"""Language ID by Bayesian evidence fusion.

log P(language | all) = log P(language | host) + temper * log P(text | language) + log P(declared | language)
+ log P(suffix | language) + const.

* Text: byte trigrams of the folded text in 2**TABLE_BITS hashed cells, counted by language over all labelled
  texts (one count table a task, summed by a grouped aggregation); tempered, since trigrams overlap, and with at
  most ``FULL`` trigrams' worth of weight, the mean over the whole text standing for longer ones.
* Declared: the lang attribute of the html tag. Suffix: the last label of the host's name. Both likelihoods are
  counted over all rows by the language that the text alone gives, with added mass for agreement.
* Host: what the text alone gives for the host's other rows, smoothed towards the registered domain's, and that
  towards all rows': each level adds ``SMOOTH`` votes spread like the level above. The suffix is evidence of its
  own and no level of this. Votes are counted by (level, language), so a host with a third of all rows is summed
  before the shuffle; the sums come back broadcast up to a checked number of hosts, else by a salted join.

A row's own vote is taken out of all counts that judge it.

Tables that are broadcast hold languages times cells; beyond ``MOST_LANGUAGES`` tasks count cells sparsely.

Cases: a null or empty text says nothing; a missing or unknown declaration, suffix or host says nothing; without
labelled texts the language is null; ties go to the language that sorts first; repeated rows each vote.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.arrowmap import with_text_columns
from tallyframe.llm.bytewords import FOLD_TABLE, sub_batches
from tallyframe.llm.shared import bounded_batches, written

TABLE_BITS, MOST_LANGUAGES = 14, 256
TEMPER, FULL, SMOOTH = 0.3, 200, 4.0
AGREES, ADDED = 8.0, 0.5

_OPENS = re.compile(rb"<!--|<(script|style|nav)\b", re.I)
_CLOSES = {b"": re.compile(rb"-->"), **{k: re.compile(rb"</" + k + rb"\s*>", re.I) for k in (b"script", b"style", b"nav")}}
_TAG = re.compile(rb"<[^<>]*>")
_ROOT = re.compile(rb"<html\b[^<>]*>", re.I)
_LANG = re.compile(rb"\blang\s*=\s*[\"']?([A-Za-z]{2,3})", re.I)


def visible(page: bytes) -> bytes:
    """What a page shows: no comments, scripts, styles, navigation or tags; entities resolved. Reads a page once, however broken it is."""
    shown, at, place, unclosed = [], 0, 0, set()
    while found := _OPENS.search(page, place):
        kind, place = (found[1] or b"").lower(), found.end()
        if kind in unclosed:
            continue
        end = _CLOSES[kind].search(page, place)
        if not end:
            unclosed.add(kind)
            continue
        shown.append(page[at : found.start()])
        at = place = end.end()
    text = _TAG.sub(b" ", b" ".join([*shown, page[at:]]))
    return html.unescape(text.decode("utf-8", "replace")).encode() if b"&" in text else text


def declared_language(page: bytes) -> str | None:
    root = _ROOT.search(page)
    found = _LANG.search(root[0]) if root else None
    return found[1].decode().lower() if found else None


def cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, cell) of each byte trigram of the folded texts, spaces squeezed."""
    folded = [b" " + b" ".join(t.translate(FOLD_TABLE).split()) + b" " for t in texts]
    size = np.array([len(x) for x in folded])
    b = np.frombuffer(b"".join(folded) + b"  ", np.uint8).astype(np.uint32)
    h = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - TABLE_BITS)
    of = np.repeat(np.arange(len(texts)), size)
    own = np.ones(len(of), bool)
    ends = np.cumsum(size)
    own[ends - 1] = False
    own[ends - 2] = False
    return of[own], h[own]


def trigram_table(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log P(cell | language)) counted over all rows with a language."""
    known = docs.where(F.col(lang_col).isNotNull())
    langs = sorted(r[0] for r in known.groupBy(F.lower(F.col(lang_col).cast("string"))).count().collect())
    bounded_batches(docs.sparkSession)
    number = {x: i for i, x in enumerate(langs)}

    def counted(at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], ["at", "n"])

    def work_many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for at, texts in sub_batches(batch.column(0)):
                of, cell = cells(texts)
                yield counted(*np.unique((lang[at + of] << TABLE_BITS) + cell, return_counts=True))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((max(1, len(number)), 1 << TABLE_BITS), np.int64)
        for batch in batches:
            lang = np.array([number[x] for x in batch.column(1).to_pylist()], np.int64)
            for at, texts in sub_batches(batch.column(0)):
                of, cell = cells(texts)
                n += np.bincount((lang[at + of] << TABLE_BITS) + cell, minlength=n.size).reshape(n.shape)
        at = np.flatnonzero(n)
        yield counted(at, n.ravel()[at])

    counts = np.zeros(max(1, len(langs)) << TABLE_BITS)
    for r in known.select(text_col, F.lower(F.col(lang_col).cast("string")).alias("lang")).mapInArrow(work if len(langs) <= MOST_LANGUAGES else work_many, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r.at] = r.n
    counts = counts.reshape(-1, 1 << TABLE_BITS) + 0.5
    return langs, np.log(counts / counts.sum(1, keepdims=True))


def text_evidence(df: DataFrame, table: np.ndarray, langs: list[str], text_col: str = "text", is_html: bool = False) -> DataFrame:
    """df with ``declared`` (of html; else null) and ``evidence``: array<double>, tempered log P(text | language)."""
    shared = df.sparkSession.sparkContext.broadcast(table)
    fields = [T.StructField("declared", T.StringType()), T.StructField("evidence", T.ArrayType(T.DoubleType()))]

    def factory():
        own = shared.value

        def compute(texts):
            declared = [declared_language(t) if is_html else None for t in texts]
            of, cell = cells([visible(t) for t in texts] if is_html else texts)
            n = np.bincount(of, minlength=len(texts))
            weight = TEMPER * np.minimum(n, FULL) / np.maximum(n, 1)
            sums = np.stack([np.bincount(of, row[cell], len(texts)) for row in own]) if langs else np.zeros((0, len(texts)))
            return declared, (sums * weight).T.tolist()

        return compute

    return with_text_columns(df, text_col, fields, factory)


def _share(votes: DataFrame, name: str, langs: int) -> DataFrame:
    """votes by language of each value of a column, as an array in language order."""
    counted = votes.where(f"{name} IS NOT NULL AND vote IS NOT NULL").groupBy(name, "vote").agg(F.count("*").alias("n"))
    return counted.groupBy(name).agg(*[F.coalesce(F.sum(F.when(F.col("vote") == k, F.col("n"))), F.lit(0)).cast("double").alias(f"v{k}") for k in range(langs)]).select(name, F.array(*[f"v{k}" for k in range(langs)]).alias(f"{name}_votes"))


def _joined(rows: DataFrame, votes: DataFrame, name: str, broadcast_rows: int = 200_000, salts: int = 64) -> DataFrame:
    """rows with the votes of their value of a column. Up to ``broadcast_rows`` values are broadcast; more are joined with
    a salt, so that a value with a third of all rows is dealt over ``salts`` tasks."""
    votes = written(votes, "votes")
    if votes.count() <= broadcast_rows:
        return rows.join(F.broadcast(votes), name, "left")
    salted = votes.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    return dealt.join(salted, [name, "__salt"], "left").drop("__salt")


def fuse(rows: DataFrame, langs: list[str], broadcast_rows: int = 200_000) -> DataFrame:
    """rows (declared, evidence, host, domain, suffix; of a written table) with text_lang, lang and probability."""
    n = len(langs)
    if not n:
        return rows.select("*", F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"))
    codes = F.array(*[F.lit(x) for x in langs])
    best = lambda a: F.array_position(a, F.array_max(a)).cast("int") - 1
    # an empty text votes for none
    spoken = F.array_max("evidence") < 0
    rows = rows.withColumn("declared", F.when(F.array_contains(codes, F.col("declared")), F.col("declared"))).withColumn("vote", F.when(spoken, best(F.col("evidence"))))
    zero = F.array_repeat(F.lit(0.0), n)
    total = dict(rows.where("vote IS NOT NULL").groupBy("vote").count().collect())
    mine = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(k == F.col("vote"), 1.0).otherwise(0.0))
    less = lambda a, b: F.zip_with(a, b, lambda v, m: F.greatest(v - m, F.lit(0.0)))
    for name in ("host", "domain", "suffix", "declared"):
        rows = _joined(rows, _share(rows, name, n), name, broadcast_rows)
        # a row's own vote is no evidence about it
        rows = rows.withColumn(f"{name}_votes", F.when(F.col(f"{name}_votes").isNotNull(), less(F.col(f"{name}_votes"), mine)).otherwise(zero))
    counts = F.array(*[F.lit(float(total.get(k, 0))) for k in range(n)])
    whole = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumn("__all", less(counts, mine))
    prior = F.transform("__all", lambda x: (x + F.lit(1.0)) / (whole(F.col("__all")) + F.lit(float(n))))
    for name in ("domain", "host"):
        rows = rows.withColumn("__prior", prior).withColumn("__sum", whole(F.col(f"{name}_votes")))
        rows = rows.withColumn(f"{name}_prior", F.zip_with(F.col(f"{name}_votes"), F.col("__prior"), lambda v, p: (v + F.lit(SMOOTH) * p) / (F.col("__sum") + F.lit(SMOOTH))))
        prior = F.col(f"{name}_prior")
    # P(value | language): votes of the value's rows over the language's votes, with mass for agreement of a declaration
    likely = F.transform(F.arrays_zip(F.col("declared_votes").alias("v"), F.col("__all").alias("t"), codes.alias("c")), lambda s: F.when(F.col("declared").isNull(), 0.0).otherwise(F.log((s["v"] + F.when(s["c"] == F.col("declared"), AGREES).otherwise(ADDED)) / (s["t"] + AGREES + ADDED * n))))
    by_suffix = F.transform(F.arrays_zip(F.col("suffix_votes").alias("v"), F.col("__all").alias("t")), lambda s: F.when(F.col("suffix").isNull(), 0.0).otherwise(F.log((s["v"] + ADDED) / (s["t"] + 1.0 + ADDED * n))))
    rows = rows.withColumn("__declared", likely).withColumn("__suffix", by_suffix)
    logs = F.transform(F.arrays_zip(F.col("evidence").alias("e"), F.col("host_prior").alias("p"), F.col("__declared").alias("d"), F.col("__suffix").alias("s")), lambda x: x["e"] + F.log(x["p"]) + x["d"] + x["s"])
    rows = rows.withColumn("__logs", logs).withColumn("__top", F.array_max("__logs"))
    rows = rows.withColumn("lang", F.get(codes, best(F.col("__logs")))).withColumn("text_lang", F.get(codes, F.col("vote")))
    return rows.withColumn("probability", 1.0 / whole(F.transform("__logs", lambda x: F.exp(x - F.col("__top")))))


def address(rows: DataFrame, url_col: str = "url") -> DataFrame:
    """rows with host, domain (the host's last two labels) and suffix (its last label) of an address; null without one."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = rows.withColumn("host", F.when(host != "", host))
    return rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)).withColumn("domain", F.when(F.col("domain") != "", F.col("domain"))).withColumn("suffix", F.when(F.col("host").contains("."), F.substring_index("host", ".", -1)))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, doc_id, lang, probability, text_lang, declared, host) of all pages (page_id, url, html) and documents.

    Trigrams are counted over the documents' ``lang``. A document has no address: its source stands for the host.
    """
    langs, table = trigram_table(docs)
    null = lambda t: F.lit(None).cast(t)
    of_pages = text_evidence(address(pages.select("page_id", "url", "html")), table, langs, "html", is_html=True).select("page_id", null("long").alias("doc_id"), "host", "domain", "suffix", "declared", "evidence")
    of_docs = text_evidence(docs.select("doc_id", "source", "text"), table, langs).select(null("long").alias("page_id"), "doc_id", F.col("source").alias("host"), null("string").alias("domain"), null("string").alias("suffix"), "declared", "evidence")
    rows = written(of_pages.unionByName(of_docs), "evidence")
    return fuse(rows, langs).select("page_id", "doc_id", "lang", "probability", "text_lang", "declared", "host")
