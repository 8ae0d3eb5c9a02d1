"""SpotSigs fingerprints: chains of content words after common words, compared by pruned Jaccard.

A text's words are its lower-cased runs of letters and digits. Each run of common words (``COMMON``) anchors a
signature: its last word and the next ``chain`` content words, passing over common words between them; the
start of the text anchors one too, so every text with a content word has a signature. The fingerprint is the
set of the signatures' crc32, as an ascending array; ``fingerprint_text`` writes it in hex, eight digits each.

``near_pairs`` compares fingerprints: sets fall into partitions by length whose bounds grow by 1/threshold, so
that only neighbouring partitions can hold similar sets; sets are joined on their rarest signatures (as many
as the threshold makes necessary), pruned by length, and compared exactly: every pair of a bucket, whose members
are dealt over blocks so that no task holds a frequent signature alone. Equal sets are one set from the start,
so a group of copies gives a star.

Everything is DataFrame functions. Cases: null is an empty text; a text without content words has an empty
fingerprint, like another empty one by 1 and any other by 0; rows of one id are compared each; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import written

#: Common words of English, German, French and Spanish.
COMMON = (
    "the of and a to in is that for it with as was on by be are this from at or an not but have had "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch es an "
    "le la les de et un une des du en que qui dans pour par sur au pas ce il est "
    "el los las y que en un una por con para del se no al lo su"
)


def trie_pattern(words: list[str]) -> str:
    """A regular expression of the words that branches by letter."""
    tree: dict = {}
    for w in words:
        node = tree
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def made(node: dict) -> str:
        parts = [c + made(n) for c, n in sorted(node.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})"
        return body + ("?" if "" in node else "")

    return made(tree)


_STOP = trie_pattern(sorted(set(COMMON.split())))


def signatures(text: F.Column, chain: int = 2) -> F.Column:
    """The fingerprint of a text column: array<long>, ascending."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    plain = F.ltrim(F.regexp_replace(plain, " {2,}", " "))
    # each common word is marked by itself: a repeated group would recurse over a long run of them
    marked = F.regexp_replace(F.concat(F.lit("^ "), plain), rf"(?<= )({_STOP} )", "|$1")
    spots = F.filter(F.split(marked, r"\|"), lambda s: F.startswith(s, F.lit("^")) | (F.locate(" ", s) < F.length(s)))
    after = lambda s: F.substr(s, F.locate(" ", s) + 1)

    def signature(spots, spot, i):
        for k in range(1, chain):
            spot = F.concat(spot, after(F.coalesce(F.get(spots, i + k), F.lit(""))))
        # the start of the text may have no content word of its own
        spot = F.when(i == 0, F.concat(spot, after(F.coalesce(F.get(spots, i + chain), F.lit(""))))).otherwise(spot)
        return F.rtrim(F.substring_index(spot, " ", chain + 1))

    # the array is bound to a variable: named twice as an expression it would be made anew for each element
    made = F.get(F.transform(F.array(spots), lambda all: F.transform(all, lambda s, i: signature(all, s, i))), 0)
    chains = F.filter(made, lambda s: F.contains(s, F.lit(" ")))
    return F.array_sort(F.array_distinct(F.transform(chains, lambda s: F.crc32(s))))


def fingerprint_text(signs: F.Column) -> F.Column:
    return F.lower(F.array_join(F.transform(signs, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def likeness(x: F.Column, y: F.Column) -> F.Column:
    """Jaccard likeness of two fingerprints; lengths that leave none in common need no intersection."""
    n, m = F.size(x), F.size(y)
    same = F.size(F.array_intersect(x, y))
    return F.when((n == 0) & (m == 0), F.lit(1.0)).when(F.least(n, m) == 0, F.lit(0.0)).otherwise(same / (n + m - same))


def _key(df: DataFrame, id_col: str) -> tuple[F.Column, int, bool]:
    """A key without nulls; what it is for a null id (below all others); and whether ids repeat."""
    none = (df.agg(F.min(id_col)).first()[0] or 0) - 1
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(none).cast("long"))
    repeats = not df.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return key, none, repeats


def followers(sizes: DataFrame, rows_each: int = 20_000, most: int = 256) -> DataFrame:
    """(k, before, before_chars): for each key of ``sizes`` (k, chars) the key before it; the first follows the last.

    Keys fall into at most ``most`` ranges of about equal size; a range's neighbour is its own smallest key, which
    the driver holds: ``most`` numbers.
    """
    total = sizes.count()
    n = max(1, min(most, total // rows_each))
    cuts = sorted(set(sizes.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10_000)).first()[0] or [])) if n > 1 else []

    def bucket(a: int, z: int) -> F.Column:
        if a == z:
            return F.lit(a)
        mid = (a + z) // 2
        return F.when(F.col("k") <= F.lit(cuts[mid]), bucket(a, mid)).otherwise(bucket(mid + 1, z))

    placed = sizes.withColumn("range", bucket(0, len(cuts)))
    heads = dict(placed.groupBy("range").agg(F.min("k")).collect())
    order = sorted(heads)
    after = {r: heads[order[(i + 1) % len(order)]] for i, r in enumerate(order)}
    other = F.lit(None).cast("long")
    if after:
        other = F.element_at(F.create_map(*[F.lit(x) for r in order for x in (r, after[r])]), F.col("range"))
    w = Window.partitionBy("range").orderBy("k")
    return placed.select(F.coalesce(F.lead("k").over(w), other).alias("k"), F.col("k").alias("before"), F.col("chars").alias("before_chars"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 2) -> DataFrame:
    """(id, text, n_chars, edited, signs, edited_signs, next_signs) of each row.

    edited: the text with its last floor(n_chars / 2) characters replaced by the first as many of the next text
    by id. Of rows that share the next id, the least text counts as next.
    """
    own = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    key, none, repeats = _key(own, "id")
    own = own.select(key.alias("k"), "text")
    sizes = own.select("k", F.char_length("text").alias("chars"))
    # ids that don't repeat need no shuffle, and so no file of a few rows for each of its partitions
    sizes = written(sizes.groupBy("k").agg(F.max("chars").alias("chars")) if repeats else sizes, "sizes")
    # both joins read the same columns of this, so that Spark makes and shuffles it once
    texts = own.withColumn("signs", signatures(F.col("text"), chain))
    follow = followers(sizes)
    nexts = texts.join(follow, "k").select(F.col("before").alias("k"), F.substr("text", F.lit(1), F.floor(F.col("before_chars") / 2).cast("int")).alias("piece"), F.col("signs").alias("next_signs"), *([F.col("text").alias("whole")] if repeats else []))
    if repeats:
        nexts = nexts.groupBy("k").agg(F.min(F.struct("whole", "piece", "next_signs")).alias("m")).select("k", "m.piece", "m.next_signs")
    joined = texts.join(nexts, "k")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - half), F.substr("piece", F.lit(1), half))
    id_ = F.when(F.col("k") != none, F.col("k")).cast(df.schema[id_col].dataType).alias("id")
    return joined.select(id_, "text", n.cast("long").alias("n_chars"), edited.alias("edited"), "signs", "next_signs").withColumn("edited_signs", signatures(F.col("edited"), chain))


def near_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, chain: int = 2, most: int = 256) -> DataFrame:
    """(id, near, likeness): texts of an equal fingerprint with its smallest id, and all near pairs of these ids, the smaller as near."""
    signed = written(df.select(F.col(id_col).alias("id"), signatures(F.col(text_col), chain).alias("signs")), "signs")
    sets = signed.groupBy("signs").agg(F.min("id").alias("rep")).withColumn("n", F.size("signs"))
    equal = signed.join(sets.select("signs", "rep"), "signs").where("id <> rep").select("id", F.col("rep").alias("near"), F.lit(1.0).alias("likeness"))
    each = sets.where("n > 0").select("rep", "n", F.explode("signs").alias("sign"))
    rarity = each.groupBy("sign").agg(F.count("*").alias("sets"))
    ranked = each.join(rarity, "sign").groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("sets", "sign"))).alias("by"))
    need = (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")
    prefix = ranked.select("rep", "n", F.explode(F.slice("by", F.lit(1), need)).alias("s")).select("rep", "n", F.col("s.sign").alias("sign"))
    # a set stands in its own length partition and the next, so that similar sets meet in one
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(max(-math.log(threshold) * (1 + 1e-6), 1e-9)))
    placed = prefix.withColumn("part", F.explode(F.array(part, part + 1))).withColumn("own", F.col("part") == part)
    # every two members of a bucket meet in one pair of blocks
    held = placed.groupBy("sign", "part").agg(F.ceil(F.count("*") / most).alias("blocks"), F.count("*").alias("members")).where("members > 1")
    met = placed.join(held, ["sign", "part"]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    p, q = (met.select("sign", "part", "lo", "hi", *[F.col(c).alias(f"{c}_{side}") for c in ("rep", "n", "block", "own")]) for side in "pq")
    fits = F.least("n_p", "n_q") >= F.greatest("n_p", "n_q") * F.lit(threshold) - 1e-9
    once = ((F.col("lo") == F.col("hi")) | (F.col("block_p") != F.col("block_q"))) & (F.col("own_p") | F.col("own_q"))
    pairs = p.join(q, ["sign", "part", "lo", "hi"]).where((F.col("rep_p") > F.col("rep_q")) & fits & once).select(F.col("rep_p").alias("rep"), F.col("rep_q").alias("near")).distinct()
    x, y = sets.select("rep", F.col("signs").alias("x")), sets.select(F.col("rep").alias("near"), F.col("signs").alias("y"))
    n, m = F.size("x"), F.size("y")
    pruned = pairs.join(x, "rep").join(y, "near").where(F.least(n, m) >= F.greatest(n, m) * F.lit(threshold) - 1e-9)
    close = pruned.withColumn("likeness", likeness(F.col("x"), F.col("y"))).where(F.col("likeness") >= threshold)
    return close.select(F.col("rep").alias("id"), "near", "likeness").unionByName(equal)
