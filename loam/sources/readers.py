"""Readers that give one record shape: doc_id, source_key, source_path, row, text, source_sha256."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def records(rows: DataFrame, source_key: str, text: Column, path: Column, row: Column) -> DataFrame:
    """Records with the id "<source>:<first 10 of sha1(path)>:<row>"; the digest is of the original text."""
    doc_id = F.concat_ws(":", F.lit(source_key), F.substring(F.sha1(path), 1, 10), row.cast("string"))
    body = F.coalesce(text, F.lit(""))
    return rows.select(doc_id.alias("doc_id"), F.lit(source_key).alias("source_key"), path.alias("source_path"), row.cast("long").alias("row"), body.alias("text"), F.sha2(body, 256).alias("source_sha256"))


def parquet_source(spark: SparkSession, path: str, source_key: str, text_col: str = "text") -> DataFrame:
    """Only the text column is read."""
    rows = spark.read.parquet(path).select(F.col(text_col).alias("__t"), F.col("_metadata.file_path").alias("__p"), F.col("_metadata.row_index").alias("__r"))
    return records(rows, source_key, F.col("__t"), F.col("__p"), F.col("__r"))


def jsonl_source(spark: SparkSession, path: str, source_key: str, text_col: str = "text") -> DataFrame:
    """JSON lines, gzipped or not; broken lines are left out. The row is a hash of the line within its file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("__p"))
    text = F.get_json_object("value", f"$.{text_col}")
    return records(lines.where(text.isNotNull()), source_key, text, F.col("__p"), F.xxhash64("value"))


def hash_sample(rows: DataFrame, n: int, key: Column, seed: int = 42) -> DataFrame:
    """The n rows of smallest hash: nests for growing n, needs no order and no count."""
    return rows.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256)).limit(n)


_TURNS = ArrayType(StructType([StructField("role", StringType()), StructField("content", StringType())]))


@F.pandas_udf(_TURNS)
def parse_turns(source: pd.Series) -> pd.Series:
    """Turns of a printed list of {from, value} or {role, content}; empty turns go, what can't be parsed is empty."""

    def one(text: str | None) -> list[dict]:
        try:
            made = ast.literal_eval(text or "")
            turns = [{"role": str(t.get("role", t.get("from", ""))), "content": str(t.get("content", t.get("value", "")) or "")} for t in made]
        except (ValueError, SyntaxError, AttributeError, TypeError, MemoryError, RecursionError):
            return []
        return [t for t in turns if t["content"].strip()]

    return source.map(one)


def turns_text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat_ws(": ", t["role"], t["content"])), "\n")


def format_of(content: Column, path: Column) -> Column:
    """File format by its first bytes, by the extension where they tell nothing."""
    head = F.hex(F.substring(content, 1, 8))
    starts = lambda x: head.startswith(x)
    extension = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return (
        F.when(starts("25504446"), "pdf")
        .when(starts("504B0304") & extension.isin("docx", "pptx", "epub", "xlsx"), extension)
        .when(starts("504B0304"), "zip")
        .when(starts("D0CF11E0A1B11AE1"), "ole")
        .when(starts("41542654"), "djvu")
        .when(F.lower(F.substring(content, 1, 200).cast("string")).rlike("<!doctype html|<html"), "html")
        .otherwise(F.nullif(extension, F.lit("")))
    )


def files(spark: SparkSession, path: str, pattern: str = "*", most: int | None = None) -> DataFrame:
    """(path, size) of the files below a folder, hidden caches aside, in the order of their paths; the first most of them."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))
    found = found.where(~F.contains("path", F.lit("/.cache/"))).orderBy("path")
    return found if most is None else found.limit(most)


def capped_sample(rows: DataFrame, n: int, file: Column, key: Column, per_file: int = 250, seed: int = 42) -> DataFrame:
    """n rows by hash, at most per_file of a file. The cap is taken by a window over each file, which a scan bounds."""
    h = F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256)
    few = rows.withColumn("__h", h).withColumn("__k", F.row_number().over(Window.partitionBy(file).orderBy("__h"))).where(F.col("__k") <= per_file)
    return few.orderBy("__h").limit(n).drop("__h", "__k")


def checkpoint_records(pages: DataFrame, stem: str, page: str, text: str, method: str, metadata: DataFrame) -> DataFrame:
    """(stem, page's smallest number, pages, needs_ocr, text, matched, metadata's columns) of extraction checkpoints.

    pages has a row for each page. A page that needs recognition is an empty one, so that the others keep their numbers;
    a file whose pages all do gives an empty text. Files without metadata stay, unmatched.
    """
    blank = F.when(F.col(method) == "needs_ocr", "").otherwise(F.coalesce(text, F.lit("")))
    made = pages.select(stem, F.col(page).alias("__p"), blank.alias("__t"), (F.col(method) == "needs_ocr").alias("__o")).groupBy(stem).agg(
        F.min("__p").alias(page), F.count(F.lit(1)).alias("pages"), F.count_if("__o").alias("needs_ocr"), F.array_sort(F.collect_list(F.struct("__p", "__t"))).alias("__all")
    )
    made = made.withColumn("text", F.array_join(F.transform("__all", lambda x: x["__t"]), "\n")).drop("__all")
    return made.join(metadata.withColumn("__m", F.lit(True)), stem, "left").withColumn("matched", F.coalesce("__m", F.lit(False))).drop("__m")


def write_report_rows(rows: DataFrame, path: str, kind: str) -> None:
    """Rows of an audit or a sample as CSV with a header, or as JSON lines."""
    made = rows.write.mode("overwrite")
    made.option("header", "true").csv(path) if kind == "csv" else made.json(path)
