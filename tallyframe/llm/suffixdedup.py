"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts earlier are removed.

Prefix doubling ranks every suffix by ever longer prefixes and sorts position-rank pairs until ranks are
unique or the prefix is long enough. A row for every byte would not fit the check tool's limits (README), so
suffixes travel in runs: a run is the neighbouring windows of ``length`` bytes that choose the same anchor
(``anchors``), and its rank pair is (rank of what all of its suffixes share, rank of all its bytes). In a
round Spark sorts the rank pairs with their positions:

* a run whose first rank is unique is unique and leaves;
* a run whose pair stands at an earlier position is repeated and leaves, to be removed;
* what is left (the earliest run of each pair) is cut at fixed distances from its anchor, and so ranked by a
  longer shared prefix in the next round: ``gram`` bytes, then length - width + 1 for each of ``widths``,
  the last of which is 1, so that single suffixes are compared by all ``length`` bytes.

Ranks are 64-bit hashes of the bytes; the pair has 128 bits. Repeats inside one batch of a map task leave
before the shuffle, so a group of copies brings one row a batch. Sorted partitions are read as a stream
that holds one row. Rounds are written to the shared folder.

Cases: null is an empty text; texts shorter than ``length`` are kept whole; rows of one id count as documents
in the order of their texts' md5, equal rows as one document; an empty table gives no rows. Extra columns are
carried; ``remaining`` replaces columns named like its results, ``dedup`` returns every column as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.anchors import Bytes, anchor_runs
from tallyframe.llm.bytewords import STEP, U64, mix, released_memory, sub_batches
from tallyframe.llm.shared import bounded_batches, packed, unpacked, written

LENGTH, GRAM, WIDTHS = 100, 24, (16, 4, 1)
#: A run in one number: where it starts in its text, its windows, how far its anchor lies after the start (of a
#: piece: how far the piece lies after its run's start).
_COUNT, _LEAD = 12, 12
_RANKED = "r1 long, r2 long, uid long, run long"
_SCANNED = "kind int, uid long, run long, r1 long"
REPEATED, LEFT = 1, 0


def _pack(first, count, lead) -> np.ndarray:
    return (first << (_COUNT + _LEAD)) | (count << _LEAD) | lead


def _unpack(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return run >> (_COUNT + _LEAD), (run >> _LEAD) & ((1 << _COUNT) - 1), run & ((1 << _LEAD) - 1)


def _earliest(r1, r2, uid, run) -> np.ndarray:
    """Marks the earliest row of each rank pair."""
    order = np.lexsort((run, uid, r2, r1))
    new = np.ones(len(order), bool)
    a, b = r1[order], r2[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def _ranked(r1, r2, uid, run) -> pa.RecordBatch:
    """Rows for the sort; those that repeat an earlier one of the batch are marked by a run with its sign bit set."""
    again = ~_earliest(r1, r2, uid, run)
    r1, r2, run = r1.view(np.int64).copy(), r2.view(np.int64), run.copy()
    r1[again] = mix((run[again] * 31 + uid[again]).astype(U64)).view(np.int64)  # dealt evenly, they are settled
    run[again] |= np.int64(-(2**63))
    return pa.RecordBatch.from_arrays([pa.array(r1), pa.array(r2), pa.array(uid), pa.array(run)], ["r1", "r2", "uid", "run"])


def _first_ranks(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Runs of all texts with (rank of the anchor's gram, rank of all bytes); docs has uid and text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, texts in sub_batches(batch.column(1)):
                text, first, count, lead, g, s = anchor_runs(Bytes(texts), length, gram)
                if len(text):
                    yield _ranked(g, s, ids[at + text], _pack(first, count, lead))
        released_memory()

    return docs.select("uid", "text").mapInArrow(work, _RANKED)


class Scan:
    """Reads rows in the order of (r1, r2, uid, run) and says of each whether it is repeated or left."""

    def __init__(self):
        self.r1 = self.r2 = None
        self.many = False
        self.held: tuple[int, int, int] | None = None

    def __call__(self, r1, r2, uid, run) -> pa.RecordBatch:
        settled = run < 0
        out = [(np.full(settled.sum(), REPEATED), uid[settled], run[settled] & np.int64(2**63 - 1), r1[settled])]
        r1, r2, uid, run = (x[~settled] for x in (r1, r2, uid, run))
        if len(r1):
            goes_on = self.r1 is not None and r1[0] == self.r1
            new1 = np.ones(len(r1), bool)
            new1[1:] = r1[1:] != r1[:-1]
            new1[0] = not goes_on
            new2 = new1.copy()
            new2[1:] |= r2[1:] != r2[:-1]
            new2[0] |= not (goes_on and r2[0] == self.r2)
            group = np.cumsum(new1) - (0 if goes_on else 1)
            pairs = np.bincount(group, new2)
            if goes_on:
                pairs[0] += 2 if self.many else 1
                if pairs[0] > 1 and self.held:
                    out.append(tuple(np.array([x]) for x in (LEFT, *self.held)))
                    self.held = None
            elif self.held:
                self.held = None
            left = new2 & (pairs[group] > 1)
            for kind, use in ((REPEATED, ~new2), (LEFT, left)):
                out.append((np.full(use.sum(), kind), uid[use], run[use], r1[use]))
            last = np.flatnonzero(new1)
            at = int(last[-1]) if len(last) else 0
            self.many = bool(pairs[-1] > 1)
            if self.many:
                self.held = None
            elif len(last):
                self.held = (int(uid[at]), int(run[at]), int(r1[at]))
            self.r1, self.r2 = r1[-1], r2[-1]
        kind, u, r, h = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(u, pa.int64()), pa.array(r, pa.int64()), pa.array(h, pa.int64())], ["kind", "uid", "run", "r1"])


def _round(ranked: DataFrame, name: str) -> DataFrame:
    """Sorts rank pairs with their positions; gives repeated runs and those that are left."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan()
        for batch in batches:
            made = scan(*(batch.column(i).to_numpy() for i in range(4)))
            if made.num_rows:
                yield made
        released_memory()

    ordered = ranked.repartition("r1").sortWithinPartitions("r1", "r2", "uid", "run")
    return written(ordered.mapInArrow(work, _SCANNED), name)


def _fetched(left: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(uid, run, r1, bytes): the bytes of the runs that are left."""
    grouped = left.groupBy("uid").agg(F.collect_list(F.struct("run", "r1")).alias("runs"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                text, runs = texts[i].as_py(), batch.column(2)[i].values
                run = runs.field("run").to_numpy()
                first, count, _ = _unpack(run)
                cut = [text[a : a + n] for a, n in zip(first.tolist(), (count - 1 + length).tolist())]
                ids = pa.array(np.full(len(run), batch.column(0)[i].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([ids, pa.array(run), runs.field("r1"), pa.array(cut, pa.binary())], ["uid", "run", "r1", "bytes"])
        released_memory()

    return written(docs.join(grouped, "uid").select("uid", "text", "runs").mapInArrow(work, "uid long, run long, r1 long, bytes binary"), "runs")


def _pieces(runs: DataFrame, length: int, width: int) -> DataFrame:
    """Cuts runs at multiples of ``width`` from their anchors; (rank of the shared bytes, rank of all bytes) of each piece.

    runs: uid, run (of the piece that is cut), whole (the run that ``bytes`` belongs to), r1 of the first round, bytes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            uids, pieces, wholes, grams = (batch.column(i).to_numpy() for i in range(4))
            for at, texts in sub_batches(batch.column(4)):
                part = slice(at, at + len(texts))
                b = Bytes(texts)
                first, count, lead = _unpack(pieces[part])
                whole_first, _, whole_lead = _unpack(wholes[part])
                low = first - whole_first - whole_lead  # of the piece's first window, from the anchor
                high = low + count - 1
                c0 = np.floor_divide(low, width)
                n = np.floor_divide(high, width) - c0 + 1
                own = np.repeat(np.arange(len(n)), n)
                cell = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + c0[own]
                a, z = np.maximum(cell * width, low[own]), np.minimum(cell * width + width - 1, high[own])
                anchor = (b.at + whole_lead)[own]
                shared = b.hashes(anchor + cell * width + width - 1, anchor + cell * width + length)
                whole = b.hashes(anchor + a, anchor + z + length)
                gram = grams[part].view(U64)[own]
                r1 = mix((shared * STEP + gram) * STEP + (cell + 4096).astype(U64))
                r2 = mix(whole * STEP + (a + 4096).astype(U64))
                start = whole_first[own] + whole_lead[own] + a
                yield _ranked(r1, r2, uids[part][own], _pack(start, z - a + 1, start - whole_first[own]))
        released_memory()

    return runs.select("uid", "run", "whole", "r1", "bytes").mapInArrow(work, _RANKED)


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """(uid, run): runs of windows whose bytes also start earlier; docs has uid (unique, ordered) and text."""
    if not 1 <= length < 1 << _COUNT:
        raise ValueError(f"length must lie between 1 and {(1 << _COUNT) - 1}")
    gram, widths = min(gram, length), tuple(w for w in widths if w <= length)
    bounded_batches(docs.sparkSession)
    found = _round(_first_ranks(docs, length, gram), "round")
    results = [found.where(F.col("kind") == REPEATED).select("uid", "run")]
    fetched = _fetched(found.where(F.col("kind") == LEFT), docs, length)
    runs = fetched.withColumn("whole", F.col("run"))
    for width in widths:
        found = _round(_pieces(runs, length, width), "round")
        results.append(found.where(F.col("kind") == REPEATED).select("uid", "run"))
        if width > 1:
            # a piece holds how far it starts after its run
            start = F.shiftright(F.col("run"), _COUNT + _LEAD)
            pieces = found.where(F.col("kind") == LEFT).select("uid", "run", (start - F.col("run").bitwiseAND(F.lit((1 << _LEAD) - 1))).alias("first"))
            runs = pieces.join(fetched.select("uid", start.alias("first"), F.col("run").alias("whole"), "r1", "bytes"), ["uid", "first"])
    out = results[0]
    for x in results[1:]:
        out = out.unionByName(x)
    return out


def _numbered(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """df with uid, and the documents (uid, text): one for each id and text, numbered in that order."""
    own = df.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    ids = df.select(F.col(id_col).alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    whole = isinstance(df.schema[id_col].dataType, T.IntegralType)
    if whole and ids.where("n > 1 OR id IS NULL").isEmpty():
        own = own.withColumn("uid", F.col(id_col).cast("long"))
        return own, own.select("uid", F.col("__text").alias("text"))
    own = own.withColumn("__md5", F.md5("__text"))
    keys = own.select(F.col(id_col).alias("__id"), "__md5").distinct().sort(F.asc_nulls_first("__id"), "__md5").select("__id", "__md5", F.monotonically_increasing_id().alias("uid"))
    keys = written(keys, "ids")
    own = own.join(keys, own[f"`{id_col}`"].eqNullSafe(keys["__id"]) & (own["__md5"] == keys["__md5"])).drop("__id", "__md5")
    return own, own.select("uid", F.col("__text").alias("text")).dropDuplicates(["uid"])


FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
    T.StructField("kept", T.BinaryType()),
]


SPANS = FIELDS[1].dataType


def _merged(first: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal spans of spans sorted by their starts."""
    stop = np.maximum.accumulate(stop)
    new = np.ones(len(first), bool)
    new[1:] = first[1:] > stop[:-1]
    return first[new], stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)]


def _without(a: np.ndarray, z: np.ndarray, stay: list[dict], size: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans less the bytes that stay."""
    gone = np.zeros(size + 2, np.int8)
    for x, y in zip(a.tolist(), z.tolist()):
        gone[x + 1 : y + 1] = 1
    for s in stay:
        gone[max(s["start"], 0) + 1 : max(s["stop"], 0) + 1] = 0
    gone[-1] = 0
    edges = np.flatnonzero(np.diff(gone))
    return edges[::2], edges[1::2]


def remaining(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, spare: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """df with n_bytes, removed (maximal byte spans) and kept (the other bytes, concatenated).

    spare: adds ``spared`` to a DataFrame with a column ``text``: byte spans (start, stop) that stay although they repeat.
    """
    taken = {f.name for f in FIELDS}
    columns = [c for c in df.columns if c not in taken or c in (id_col, text_col)]
    rows = packed(df.select(*[df[f"`{c}`"] for c in columns]), text_col)
    own, docs = _numbered(rows.withColumn("__of", F.col(f"__row.`{id_col}`")), "__of", "text")
    runs = repeated_windows(docs, length, **options).groupBy("uid").agg(F.collect_list("run").alias("runs"))
    own = own.select("uid", "__row", "text")
    own = spare(own) if spare else own.withColumn("spared", F.lit(None).cast(SPANS))
    joined = own.join(runs, "uid", "left").select("__row", "text", "spared", "runs")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts, sizes, spans, rest = part.column(1).cast(pa.binary()), [], [], []
                for i in range(part.num_rows):
                    text, own_runs = texts[i].as_py() or b"", part.column(3)[i]
                    sizes.append(len(text))
                    if not own_runs.is_valid:
                        spans.append([])
                        rest.append(text)
                        continue
                    first, count, _ = _unpack(np.sort(own_runs.values.to_numpy()))
                    a, z = _merged(first, first + count - 1 + length)
                    if stay := part.column(2)[i].as_py():
                        a, z = _without(a, z, stay, len(text))
                    spans.append([{"start": x, "stop": y} for x, y in zip(a.tolist(), z.tolist())])
                    edges = [0, *np.stack([a, z], 1).ravel().tolist(), len(text)]
                    rest.append(b"".join(text[x:y] for x, y in zip(edges[::2], edges[1::2])))
                made = [pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), pa.array(rest, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)] + made, ["__row", "text", *(f.name for f in FIELDS)])
        released_memory()

    found = joined.mapInArrow(work, T.StructType([joined.schema["__row"], joined.schema["text"]] + FIELDS))
    own_columns = [(F.col("text") if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in columns]
    return found.select(*own_columns, *[f.name for f in FIELDS if f.name not in columns])


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """df's rows and columns with the repeated bytes cut out of the text; bytes of a character that is cut through go too."""
    rows = packed(df, text_col).withColumn("id", F.col(f"__row.`{id_col}`"))
    found = remaining(rows, "id", "text", **options)
    return unpacked(found, df.columns, text_col, whole_characters(F.col("kept"), F.col("text").isNull()))


def whole_characters(kept: F.Column, null: F.Column) -> F.Column:
    @F.pandas_udf("string")
    def decoded(x):
        return x.map(lambda b: b.decode("utf-8", "ignore"))

    return F.when(~null, decoded(kept))
