"""Sources: folders of files, masters, words, and second readings. Documents' text layers come from a pluggable reader."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORDS = "file string, page int, word_ix int, text string, x0 double, x1 double, top double, bottom double, source string, error string"


def files(spark: SparkSession, folder: str, only: str = "", pattern: str = "*.pdf") -> DataFrame:
    """(path, name, length, modificationTime, content) of the folder's files, sub-folders too, whose name holds ``only``, by path.

    A folder that is missing, or has no such file, is an error.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    name = F.substring_index("path", "/", -1)
    found = found.withColumn("name", name).where(F.contains(F.lower("name"), F.lit(only.lower()))).orderBy("path")
    if found.select("path").isEmpty():
        raise FileNotFoundError(f"no {pattern} in {folder}" + (f" with {only!r} in its name" if only else ""))
    return found


def words(found: DataFrame, read: Callable[[bytes], list[tuple]]) -> DataFrame:
    """Words of each file by ``read`` (content -> (page, text, x0, x1, top, bottom) rows); a file that fails gives one row with its error."""

    schema = to_arrow_schema(T._parse_datatype_string(WORDS))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    rows = read(content)
                    page, text, x0, x1, top, bottom = (list(c) for c in zip(*rows)) if rows else ([],) * 6
                    columns = [[path] * len(text), page, list(range(len(text))), text, x0, x1, top, bottom, ["text"] * len(text), [None] * len(text)]
                except Exception as e:  # a corrupt file is a row of the result, not the end of the run
                    columns = [[path], *[[None]] * 8, [f"{type(e).__name__}: {e}"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return found.select("path", "content").mapInArrow(work, WORDS)


def cached_words(found: DataFrame, read: Callable[[bytes], list[tuple]], cache: str) -> DataFrame:
    """``words`` of files that the cache holds no words of under their key (path, size, time), written to it, with those that it holds.

    A file that changes has another key, so what the cache holds of it before isn't read any more.
    """
    spark = found.sparkSession
    keyed = found.withColumn("key", cache_key(F.col("path"), F.col("length"), F.col("modificationTime")))
    schema = f"{WORDS}, key string"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(cache)
    exists = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
    held = spark.read.schema(schema).parquet(cache) if exists else spark.createDataFrame([], schema)
    new = keyed.join(held.select("key").distinct(), "key", "left_anti")
    words(new, read).join(new.select(F.col("path").alias("file"), "key"), "file").select(*held.columns).write.mode("append").parquet(cache)
    return spark.read.schema(schema).parquet(cache).join(keyed.select("key"), "key", "left_semi").drop("key")


def second_pass(first: DataFrame, second: DataFrame, share: float = 0.8) -> DataFrame:
    """The pages' words of the second pass where it has ``share`` of the first's number of words at least, else of the first."""
    page = ["file", "page"]
    n, m = (df.groupBy(*page).agg(F.count("*").alias(c)) for df, c in ((first, "n"), (second, "m")))
    kept = n.join(m, page, "full").withColumn("use", F.coalesce(F.col("m"), F.lit(0)) >= F.coalesce(F.col("n"), F.lit(0)) * share)
    take = lambda df, use: df.join(kept.where(use).select(*page), page, "left_semi")
    return take(first, ~F.col("use")).unionByName(take(second, F.col("use")))


def kept_words(ocr: DataFrame, least: float = 30) -> DataFrame:
    """Recognised words that are not blank and at least ``least`` sure; an unreadable confidence counts as -1."""
    return ocr.where((F.trim("text") != "") & (F.coalesce(F.col("conf").try_cast("double"), F.lit(-1.0)) >= least))


def second_reading(pages: DataFrame, again: DataFrame, least: int = 60) -> DataFrame:
    """pages (file, page, text) with source: pages of fewer than ``least`` letters take the second reading if there is one."""
    short = F.length(F.trim(F.coalesce(F.col("text"), F.lit("")))) < least
    out = pages.join(again.withColumnRenamed("text", "__again"), ["file", "page"], "left")
    use = short & F.col("__again").isNotNull()
    return out.withColumn("source", F.when(use, "ocr").otherwise("text")).withColumn("text", F.when(use, F.col("__again")).otherwise(F.col("text"))).drop("__again")


def guess_language(text: Column, cues: dict[str, list[str]], least: int = 2, default: str = "eng") -> Column:
    """The language most of whose cues a text contains, the first of equals; the default below ``least``."""
    counts = F.array(*[F.aggregate(F.array(*[F.contains(text, F.lit(c)).cast("int") for c in words]), F.lit(0), lambda s, x: s + x) for words in cues.values()])
    best = F.array_max(counts)
    return F.when(best >= least, F.get(F.array(*[F.lit(x) for x in cues]), F.array_position(counts, best).cast("int") - 1)).otherwise(default)


def cache_key(path: Column, size: Column, modified: Column, dpi: int = 300, version: int = 1) -> Column:
    return F.sha1(F.concat_ws("|", path, size.cast("string"), modified.cast("string"), F.lit(str(dpi)), F.lit(str(version))))


def page_stubs(found: DataFrame, count: Column | None = None) -> DataFrame:
    """(file, page, width, height) of files without a reader: as many pages as stated, else one."""
    n = F.greatest(F.coalesce(count if count is not None else F.lit(1), F.lit(1)), F.lit(1))
    return found.select(F.col("path").alias("file"), F.explode(F.sequence(F.lit(1), n)).alias("page"), F.lit(612.0).alias("width"), F.lit(792.0).alias("height"))


def master(spark: SparkSession, path: str, key: str, schema: T.StructType | str) -> DataFrame:
    """The objects in the array ``key`` of a JSON master; a missing file gives no rows."""
    element = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    whole = T.StructType([T.StructField(key, T.ArrayType(element))])
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], element)
    rows = spark.read.schema(whole).option("multiLine", True).json(path)
    return rows.select(F.explode(key).alias("r")).where("r IS NOT NULL").select("r.*")


ORG = "company_code string, company_name string, vat_id string, business_units array<struct<business_unit_code:string,business_unit_name:string,vat_id:string,locations:array<struct<location_code:string,location_name:string,invoice_to_address:string>>>>"


def organisation(companies: DataFrame) -> DataFrame:
    """One row a location of the company, unit, location tree; the unit's VAT id, else the company's, else empty."""
    unit = companies.select("company_code", "company_name", F.col("vat_id").alias("v"), F.explode("business_units").alias("u"))
    leaf = unit.select("*", F.explode("u.locations").alias("l"))
    vat = F.coalesce(F.nullif(F.col("u.vat_id"), F.lit("")), F.nullif(F.col("v"), F.lit("")), F.lit(""))
    return leaf.select("company_code", "company_name", "u.business_unit_code", "u.business_unit_name", "l.location_code", "l.location_name", "l.invoice_to_address", vat.alias("vat_id"))


def salvaged_json(text: Column, schema: str) -> Column:
    """The first {...} of a model's answer, parsed; null where there is none."""
    return F.from_json(F.nullif(F.regexp_extract(text, r"(?s)(\{.*\})", 1), F.lit("")), schema)


def write_files(df: DataFrame, path: str, file_col: str = "file") -> None:
    """One JSON object a file, under ``path`` in a folder of the file's name without its ending; equal names of other folders don't collide.

    The folder's name is the file's path with its ending dropped; the object keeps the whole name.
    """
    stem = F.regexp_replace(F.col(file_col), r"\.[^./]*$", "")
    rest = [c for c in df.columns if c != file_col]
    df.select(stem.alias("__stem"), F.to_json(F.struct(file_col, *rest), {"pretty": "true"}).alias("value")).write.partitionBy("__stem").text(path)
