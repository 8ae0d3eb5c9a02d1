"""Sharding by a k-d tree over metadata: every leaf is a shard of nearly equal bytes.

Rows of equal texts are one unit with the least of their metadata, so copies share a shard; only a group that
weighs more than ``1 / PIECES`` of a shard, in bytes or rows, is dealt into pieces by a hash of the id, and the
pieces are neighbours in every order, so that a heavy group is cut at as few places as the bytes ask for.

A node that is to become m shards is cut along its widest dimension at the weighted quantile m//2 / m (the
weighted median for even m), units weighing their bytes, until leaves hold the target bytes. Dimensions are
scaled to 31 bits (numbers by their range, strings by crc32, nulls first); 31 bits of the text's hash break
ties, so one value that holds a third of all rows is still cut where the bytes ask for it.

All nodes of a level are cut together. Histograms of ``BUCKETS`` buckets over each node's range of keys find the
bucket of the quantile by running sums (at most nodes times buckets rows, summed on the map side before); the next
round looks into that bucket alone. The driver gets one row a node. A level is three small arrays by node, and a
row's leaf one fold over the levels, so plans stay small. Only DataFrame functions run; no row leaves the executors.

Cases: a null text weighs the eight bytes of a row and is equal to an empty one; equal rows are separate rows; an
empty table gives no rows; with fewer units than shards some shards stay empty; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.shared import written

BUCKETS = 4096
#: A cut stands once the bucket that holds it weighs less than this share of a shard.
SLACK = 1e-4
#: A group of equal texts is dealt into pieces of such a part of a shard; the piece number has so many bits.
PIECES, PIECE_BITS = 512, 14
ROW_BYTES = 8
#: Rows that get their slots together, on average.
CHUNK_ROWS = 50_000


@dataclass
class Level:
    """By node (the first shard of its leaves): the dimension and key of its cut, and the node right of the cut."""

    dims: list[int] = field(default_factory=list)
    cuts: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)


def _longs(values: list[int]) -> str:
    return f"array({', '.join(f'{v}L' for v in values)})"


def _key(dims: F.Column, dim: F.Column) -> F.Column:
    return F.shiftleft(F.get(dims, dim.cast("int")), 31).bitwiseOR(F.col("tie"))


def node_of(levels: list[Level]) -> F.Column:
    """The node that a unit (dims, tie) is in after the levels."""
    start = F.lit(0).cast("long")
    if not levels:
        return start
    steps = F.expr(f"array({', '.join(f'struct({_longs(x.dims)} AS d, {_longs(x.cuts)} AS c, {_longs(x.right)} AS r)' for x in levels)})")

    def step(node, s):
        at = node.cast("int")
        return F.when(_key(F.col("dims"), F.get(s["d"], at)) < F.get(s["c"], at), node).otherwise(F.get(s["r"], at))

    return F.aggregate(steps, start, step)


def skeleton(df: DataFrame, dims: list[str], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, size, crc, same, dims) of every row, written to the shared folder; same: 64 bits of the text's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(id_col).alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("crc"), F.xxhash64(text).alias("same")]
    base = written(df.select(*own, *[F.col(d).alias(f"x{i}") for i, d in enumerate(dims)]), "kd")
    numeric = [i for i, d in enumerate(dims) if isinstance(df.schema[d].dataType, T.NumericType)]
    as_double = {i: F.nanvl(F.col(f"x{i}").cast("double"), F.lit(None)) for i in numeric}
    ends = base.agg(F.lit(0).alias("_"), *[f(as_double[i]).alias(f"{n}{i}") for i in numeric for n, f in (("a", F.min), ("z", F.max))]).first()
    keys = []
    for i in range(len(dims)):
        if i in numeric:
            a, z = ends[f"a{i}"] or 0.0, ends[f"z{i}"] or 0.0
            scaled = F.floor((as_double[i] - F.lit(a)) / F.lit((z - a) or 1.0) * F.lit(float(2**31 - 2))) + 1
        else:
            scaled = F.shiftright(F.crc32(F.col(f"x{i}").cast("string")), 1)
        keys.append(F.coalesce(scaled.cast("long"), F.lit(0).cast("long")))
    return base.select("doc_id", "size", "crc", "same", F.array(*keys).alias("dims"))


def units(rows: DataFrame, shards: int, dims: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the dims and tie of their unit, units: dims, tie, w): a unit is a text, or a piece of a heavy group.

    At most 2 * shards * PIECES groups are heavy: that many (hash, pieces) pairs are broadcast. Rows of other groups meet
    their group's metadata in one join, rows without copies and rows of heavy groups dealt evenly.
    """
    groups = rows.groupBy("same").agg(F.sum("size").alias("w"), F.count("*").alias("n"), *[F.min(F.get("dims", F.lit(i))).alias(f"d{i}") for i in range(dims)])
    groups = written(groups.select("same", "w", "n", F.array(*[f"d{i}" for i in range(dims)]).alias("dims")), "groups")
    whole = groups.agg(F.sum("w").alias("w"), F.sum("n").alias("n")).first()
    part_w, part_n = (whole.w or 0) / (shards * PIECES) or 1.0, (whole.n or 0) / (shards * PIECES) or 1.0
    pieces = F.least(F.greatest(F.ceil(F.col("w") / part_w), F.ceil(F.col("n") / part_n)), F.lit(2**PIECE_BITS))
    heavy = groups.where((F.col("n") > 1) & ((F.col("w") > part_w) | (F.col("n") > part_n))).select("same", pieces.cast("long").alias("pieces"), F.col("dims").alias("group_dims"))
    heavy = written(heavy, "heavy")
    dealt = rows.join(F.broadcast(heavy), "same", "left")
    several = groups.where("n > 1").join(F.broadcast(heavy.select("same")), "same", "left_anti").select(F.col("same").alias("of"), F.col("dims").alias("several_dims"))
    of = F.when(F.col("pieces").isNull(), F.col("same")).otherwise(F.xxhash64("doc_id", "crc"))
    dealt = dealt.withColumn("of", of).join(several, "of", "left").drop("of")
    own_dims = F.when(F.col("pieces").isNotNull(), F.col("group_dims")).otherwise(F.coalesce("several_dims", "dims"))
    high = F.shiftleft(F.shiftrightunsigned("same", 64 - 31 + PIECE_BITS), PIECE_BITS)
    piece = F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("doc_id", "crc", F.lit(7)), F.col("pieces"))).otherwise(F.col("same").bitwiseAND(F.lit(2**PIECE_BITS - 1)))
    placed = written(dealt.select("doc_id", "size", "crc", "same", own_dims.alias("dims"), high.bitwiseOR(piece).alias("tie"), F.col("pieces").isNotNull().alias("heavy")), "placed")
    light = groups.join(F.broadcast(heavy.select("same")), "same", "left_anti").select("dims", high.bitwiseOR(F.col("same").bitwiseAND(F.lit(2**PIECE_BITS - 1))).alias("tie"), "w")
    cut_up = placed.where("heavy").groupBy("same", "dims", "tie").agg(F.sum("size").alias("w")).select("dims", "tie", "w")
    return placed, written(light.unionByName(cut_up), "units")


@dataclass
class Cut:
    shards: int
    weight: float = 0.0
    dim: int = 0
    low: int = 0
    step: int = 1
    below: float = 0.0
    cut: int = 0
    done: bool = True


def _cuts(inside: DataFrame, nodes: dict[int, Cut], size: int) -> None:
    """Finds each node's cut; inside: units with their node, size: how many nodes there can be."""
    slack = SLACK * max((n.weight / n.shards for n in nodes.values()), default=0)
    while todo := {k: n for k, n in nodes.items() if not n.done}:
        by = lambda f, none=0: F.expr(f"get({_longs([f(todo[k]) if k in todo else none for k in range(size)])}, cast(node AS int))")
        goals = [float(todo[k].weight * (todo[k].shards // 2) / todo[k].shards - todo[k].below) if k in todo else 0.0 for k in range(size)]
        keyed = inside.select("node", "w", _key(F.col("dims"), by(lambda n: n.dim)).alias("key"))
        keyed = keyed.select("node", "w", "key", F.floor((F.col("key") - by(lambda n: n.low, 2**62)) / by(lambda n: n.step, 1)).alias("bucket"))
        buckets = keyed.where((F.col("bucket") >= 0) & (F.col("bucket") < BUCKETS)).groupBy("node", "bucket").agg(F.sum("w").alias("w"), F.min("key").alias("a"), F.max("key").alias("z"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bucket"))
        total = F.sum("w").over(Window.partitionBy("node"))
        summed = buckets.withColumn("upto", upto).withColumn("all", total).where(F.col("upto") >= F.expr(f"least(get(array({', '.join(f'{g!r}D' for g in goals)}), cast(node AS int)), cast(all AS double))"))
        first = summed.groupBy("node").agg(F.min_by(F.struct("w", "a", "z", "upto"), "bucket").alias("b"))
        for node, b in first.collect():
            n, goal = todo[node], todo[node].weight * (todo[node].shards // 2) / todo[node].shards
            before, after = n.below + float(b.upto - b.w), n.below + float(b.upto)
            if b.w <= slack or b.a == b.z:
                n.cut, n.done = (b.z + 1 if after - goal < goal - before else b.a), True
            else:
                n.below, n.low, n.step = before, b.a, (b.z - b.a) // BUCKETS + 1


def grow_tree(found: DataFrame, dims: int, shards: int) -> list[Level]:
    """The levels of the tree whose leaves are the shards; found: units as from ``units``."""
    levels: list[Level] = []
    sizes = {0: shards}
    while any(m > 1 for m in sizes.values()):
        inside = found.select("dims", "tie", "w", node_of(levels).alias("node"))
        ends = [f(F.get("dims", F.lit(i))).alias(f"{n}{i}") for i in range(dims) for n, f in (("a", F.min), ("z", F.max))]
        nodes = {k: Cut(m) for k, m in sizes.items() if m > 1}
        for s in inside.groupBy("node").agg(F.sum("w").alias("w"), *ends).collect():
            if n := nodes.get(s.node):
                n.weight, n.done = float(s.w), False
                n.dim = max(range(dims), key=lambda i: (s[f"z{i}"] - s[f"a{i}"], -i))
                n.low = s[f"a{n.dim}"] << 31
                n.step = ((s[f"z{n.dim}"] + 1 << 31) - n.low) // BUCKETS + 1
        _cuts(inside, nodes, shards)
        at = lambda k, f, none: f(nodes[k]) if k in nodes else none  # noqa: E731, B023
        levels.append(Level([at(k, lambda n: n.dim, 0) for k in range(shards)], [at(k, lambda n: n.cut, 2**62) for k in range(shards)], [at(k, lambda n: k + n.shards // 2, k) for k in range(shards)]))  # noqa: B023
        sizes = {j: s for k, m in sizes.items() for j, s in ([(k, m // 2), (k + m // 2, m - m // 2)] if m > 1 else [(k, m)])}
    return levels


def with_slots(rows: DataFrame, group: str = "shard", unique: str = "doc_id") -> DataFrame:
    """rows with ``slot``: gapless from 0 in each group, numbered chunk by chunk so that no task holds a whole group."""
    total = rows.count()
    chunks = max(1, total // CHUNK_ROWS)
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(unique, "crc"), F.lit(chunks)))
    counts = rows.groupBy(group, "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy(group, "chunk").orderBy(unique, "crc", "size"))
    return rows.join(offsets, [group, "chunk"]).withColumn("slot", (F.col("offset") + place - 1).cast("long"))


def shard(df: DataFrame, shards: int | None = None, target_bytes: int | None = None, dims: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, crc, shard, slot) of every row; ``target_bytes`` sets the number of shards if that is not given."""
    rows = skeleton(df, list(dims), id_col, text_col)
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    placed, found = units(rows, shards, len(dims))
    tree = grow_tree(found, len(dims), shards)
    return with_slots(placed.withColumn("shard", node_of(tree).cast("int"))).select("doc_id", "size", "crc", "shard", "slot")


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", **options) -> None:
    """df in one folder a shard under ``path``; ids must be unique."""
    placed = shard(df, id_col=id_col, **options).select(F.col("doc_id").alias(id_col), "shard", "slot")
    df.join(placed, id_col).write.partitionBy("shard").parquet(path)
