"""Reading and writing record files."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.functions.text import script_safe
from quizloom.operators.records import new_and_collided
from quizloom.schema import RECORD


def _windows() -> tuple[str, str, str]:
    """Characters of the bytes 80 to 9F in Latin-1, what Windows-1252 has there, and those it has nothing for."""
    used, to, unused = [], [], []
    for x in range(0x80, 0xA0):
        try:
            to.append(bytes([x]).decode("cp1252"))
            used.append(chr(x))
        except UnicodeDecodeError:
            unused.append(chr(x))
    return "".join(used), "".join(to), "".join(unused)


*_WINDOWS, _UNUSED = _windows()


def read_jsonl(spark: SparkSession, path, schema: T.StructType = RECORD) -> DataFrame:
    """Records with file, byte offset of the split they came from, and the text of lines that are no JSON (column _corrupt). Blank lines are skipped.

    Lines are read as Spark splits files, so a file of any size is read in parallel; line_numbers() adds numbers.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.regexp_replace("value", r"\r$", "").alias("json"))
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = lines.withColumn("at", F.monotonically_increasing_id()).where(F.trim("json") != "")
    parsed = parsed.withColumn("r", F.from_json("json", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    return parsed.select("file", "split", "at", "r.*")


def bad_lines(spark: SparkSession, path, schema: T.StructType = RECORD, most: int = 20) -> DataFrame:
    """file, line, _corrupt of the first lines that are no JSON, at most `most`: line numbers count all lines of a file, from 1.

    Numbers come from counts of lines by split: only that small table is scanned in order.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value", F.monotonically_increasing_id().alias("at"))
    sizes = lines.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "split", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    bad = read_jsonl(spark, path, schema).where("_corrupt IS NOT NULL").select("file", "split", "at", "_corrupt")
    return bad.join(starts, ["file", "split"]).select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "_corrupt").orderBy("file", "line").limit(most)


def read_json_array(spark: SparkSession, path, schema: T.StructType | str) -> DataFrame:
    """Elements of files that each hold one JSON array; a file is one task's, as the format can't be split."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def array_rows(df: DataFrame, column: str, element: str) -> DataFrame:
    """A row for each element of a column of JSON arrays of structs; broken JSON and null have none."""
    return df.select(F.inline(F.from_json(column, f"array<{element}>")))


def missing_ids(df: DataFrame, cache: DataFrame, ident: str = "id") -> DataFrame:
    """Rows of df whose id a cache lacks: what is left to compute."""
    return df.join(cache.select(ident), ident, "left_anti")


def write_cache(df: DataFrame, path: str, ident: str = "id") -> int:
    """Adds the rows whose id a Parquet cache lacks; how many. Of ids repeated in df one row goes in."""
    spark = df.sparkSession
    try:
        known = spark.read.parquet(path).select(ident)
    except Exception as e:  # the first run has no folder
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = df.select(ident).limit(0)
    seen = Observation()  # counted while written
    missing_ids(df.dropDuplicates([ident]), known, ident).observe(seen, F.count("*").alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def json_array(df: DataFrame, order: str) -> DataFrame:
    """One row, json: an indented JSON array of all rows, in order. For small results that are looked at: all rows meet in one."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(F.struct(*df.columns)).alias("j"))))
    return df.agg(F.concat(F.lit("[\n  "), F.array_join(F.transform(rows, lambda r: r.j), ",\n  "), F.lit("\n]")).alias("json"))


def filled_page(template: str, mark: str, json: Column) -> Column:
    """The template with its mark replaced by JSON made safe for a script element; an error if the mark isn't there."""
    if mark not in template:
        raise ValueError("the template lacks its mark")
    return F.replace(F.lit(template), F.lit(mark), script_safe(json))


def read_parts(spark: SparkSession, folder: str, derived: tuple[str, ...] = (), schema: T.StructType = RECORD) -> DataFrame:
    """All *.jsonl of a folder but derived ones and quarantines."""
    df = spark.read.option("pathGlobFilter", "*.jsonl").schema(schema).json(folder).withColumn("file", F.col("_metadata.file_name"))
    return df.where(~F.col("file").isin(*derived) & ~F.lower("file").contains("cuarentena")) if derived else df.where(~F.lower("file").contains("cuarentena"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header that may begin with a byte-order mark; all strings."""
    df = spark.read.csv(path, header=True)
    return df.toDF(*[c.removeprefix("﻿") for c in df.columns])


def read_pages(spark: SparkSession, *paths: str) -> DataFrame:
    """path and text of html, htm and txt files of folders, and of files as named: UTF-8, where that fails Windows-1252, and where that has no character the byte's own.

    A byte-order mark goes. Paths that don't exist are skipped with a warning; order by path for the order of names.
    """
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    there = []
    for p in paths:
        h = jvm.org.apache.hadoop.fs.Path(p)
        if h.getFileSystem(conf).exists(h):
            there.append(p)
        else:
            warnings.warn(f"no such file: {p}", stacklevel=2)
    if not there:
        return spark.createDataFrame([], "path string, text string")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.{html,htm,txt}").load(there)
    latin = F.decode("content", "iso-8859-1")
    windows = F.when(~F.regexp_like(latin, F.lit(f"[{_UNUSED}]")), F.translate(latin, *_WINDOWS))
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), windows, latin)
    return raw.select("path", F.regexp_replace(text, "^\ufeff", "").alias("text"))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", dry_run: bool = False) -> int:
    """JSON lines with nulls kept; dry_run: only counts."""
    if dry_run:
        return df.count()
    seen = Observation()  # counted while written: one computation, one answer
    df.observe(seen, F.count("*").alias("n")).write.mode(mode).option("ignoreNullFields", "false").json(path)
    return seen.get["n"]


def append_new(df: DataFrame, path: str, order: list[str], schema: T.StructType, dry_run: bool = False) -> tuple[int, int]:
    """Appends records whose id isn't there yet; how many went in, and how many collided."""
    spark = df.sparkSession
    try:
        known = spark.read.schema(schema).json(path).select("id")
        known.isEmpty()
    except Exception as e:  # the first run has no folder
        if "PATH_NOT_FOUND" not in str(e):
            raise
        known = spark.createDataFrame([], "id string")
    fresh, collided = new_and_collided(df, known, "id", order)
    return write_jsonl(fresh, path, "append", dry_run), collided.count()


def append_quarantine(df: DataFrame, path: str, order: list[str], schema: T.StructType | None = None, dry_run: bool = False) -> int:
    """Adds quarantined records whose id the quarantine lacks, so a rerun adds nothing; how many."""
    return append_new(df, path, order, schema or df.schema, dry_run)[0]


def payload(df: DataFrame) -> DataFrame:
    """One JSON text a row, safe within a script element."""
    return df.select(F.replace(F.to_json(F.struct("*")), F.lit("</"), F.lit("<\\/")).alias("json"))


def is_pdf(content):
    """Whether binary content begins as a PDF."""
    return F.startswith(content, F.lit(b"%PDF"))
