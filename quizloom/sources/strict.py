"""Strict loading of a corpus: unreadable lines, broken records and repeated ids of all parts in one relation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quizloom.schema import LETTERS, RECORD, Corpus, CorpusInvalid
from quizloom.session import cut, drop
from quizloom.sources.files import read_parts

#: Files of a corpus folder that are made from its parts.
DERIVED = ("corpus.jsonl", "clasificacion.jsonl", "cuarentena.jsonl", "corpus_autonomico_sespa2025.jsonl")


def part_lines(spark: SparkSession, folder: str, derived: tuple[str, ...] = DERIVED, glob: str = "*.jsonl") -> DataFrame:
    """file, split, at, json of the non-blank lines of a folder's parts (names like glob, but derived ones and quarantines, which aren't read).

    (file, split, at) is the order of lines: a file of any size is read in parallel, as Spark splits it.
    """
    name = F.col("_metadata.file_name")
    raw = spark.read.option("pathGlobFilter", glob).text(folder).where(~name.isin(*derived) & ~F.contains(name, F.lit("cuarentena")))
    return raw.select(name.alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"), F.regexp_replace("value", r"^﻿|\r$", "").alias("json"))


def record_faults(v: Column) -> Column:
    """array<string>: the rules that a record, a variant, breaks, in order. Types are those of the JSON itself, so a word where a truth value belongs is told from a missing one."""
    field = lambda c: F.try_variant_get(v, f"$.{c}", "variant")
    kind = lambda c: F.coalesce(F.schema_of_variant(field(c)), F.lit(""))
    text = lambda c: F.try_variant_get(v, f"$.{c}", "string")
    number = lambda c: F.coalesce(F.try_variant_get(v, f"$.{c}", "double"), F.try_variant_get(v, f"$.{c}", "boolean").cast("double"))
    counts = lambda c: F.regexp_like(kind(c), F.lit("^(BIGINT|DOUBLE|FLOAT|DECIMAL|BOOLEAN)"))
    within = lambda c: counts(c) & F.coalesce(number(c).between(0, 1), F.lit(False))
    there = lambda c: ~kind(c).isin("", "VOID")
    verified = F.when(kind("resp_verificada") == "STRING", text("resp_verificada") != "").when(counts("resp_verificada"), number("resp_verificada") != 0).otherwise(F.lit(False))
    letter = (kind("resp") == "STRING") & text("resp").isin(LETTERS)
    denied = (kind("resp_verificada") == "BOOLEAN") & ~verified
    checks = [(field(f.name).isNull(), f"missing {f.name}") for f in RECORD] + [
        (kind("resp_verificada") != "BOOLEAN", "verification not boolean"),
        (verified & ~F.coalesce(letter, F.lit(False)), "verified without a valid letter"),
        (denied & there("resp"), "letter without verification"),
        (~F.startswith(kind("opts"), F.lit("ARRAY")) | (F.coalesce(F.size(F.try_variant_get(v, "$.opts", "array<variant>")), F.lit(0)) <= 0), "no options"),
        (F.coalesce(F.trim(F.regexp_replace(text("q"), r"\s+", " ")), F.lit("")) == "", "empty stem"),
        (~within("conf"), "confidence outside 0 to 1"),
        (there("penalizacion") & ~within("penalizacion"), "penalty outside 0 to 1"),
        (kind("reserva") != "BOOLEAN", "reserve not boolean"),
    ]
    return F.array_compact(F.array(*[F.when(c, F.lit(m)) for c, m in checks]))


def failures(spark: SparkSession, folder: str, derived: tuple[str, ...] = DERIVED, glob: str = "*.jsonl") -> DataFrame:
    """file, line, seq, id, why of all that is wrong in a folder's parts; (file, line, seq) is the order of reading.

    A line that is no JSON object is unreadable and has no id. Of records of one id all but the first are
    repeated, with the file of the first; ids that aren't strings are no keys. Lines are counted from 1, blank
    ones too. Only faulty lines, and ids that are repeated, are joined with anything; an empty folder gives no rows.
    """
    lines = part_lines(spark, folder, derived, glob)
    sizes = lines.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    ahead = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", "split", "first", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    v = F.try_parse_json("json")
    read = lines.where(F.trim("json") != "").withColumn("v", v).withColumn("ok", F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.lit(False)))
    ident = F.when(F.col("ok") & (F.schema_of_variant(F.try_variant_get("v", "$.id", "variant")) == "STRING"), F.try_variant_get("v", "$.id", "string"))
    records = read.select("file", "split", "at", ident.alias("id"), F.when(F.col("ok"), record_faults(F.col("v"))).otherwise(F.array(F.lit("unreadable JSON"))).alias("faults"))
    records = cut(records, "records")  # used thrice; a filter on faults, put below, would parse a line anew for each of its checks
    broken = records.select("file", "split", "at", "id", F.posexplode("faults").alias("seq", "why"))
    place = F.struct("file", "split", "at")
    twice = records.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("n"), F.min(place).alias("origin")).where("n > 1")
    repeated = records.select("file", "split", "at", "id").join(twice, "id").where(place > F.col("origin"))
    repeated = repeated.select("file", "split", "at", "id", F.lit(len(RECORD) + 8).alias("seq"), F.concat(F.lit("repeated id, first in "), F.col("origin.file")).alias("why"))
    every = broken.unionByName(repeated).join(starts, ["file", "split"])
    return every.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line"), "seq", "id", "why")


def load_strict(spark: SparkSession, folder: str, derived: tuple[str, ...] = DERIVED, show: int = 20) -> Corpus:
    """The corpus of a folder's parts, or CorpusInvalid with the number of problems and the first of them, in the order of files and lines."""
    found = cut(failures(spark, folder, derived), "failures")
    if n := found.count():
        first = found.orderBy("file", "line", "seq").limit(show).collect()
        drop(found)
        told = [f"{r.file}:{r.line}: {r.why}" if r.id is None and r.why == "unreadable JSON" else f"{r.file}:{r.id or 'no id'}: {r.why}" for r in first]
        raise CorpusInvalid(f"{n} problems in the corpus:\n  " + "\n  ".join(told))
    drop(found)
    return Corpus(read_parts(spark, folder, derived))
