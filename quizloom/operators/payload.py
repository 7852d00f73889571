"""Records as compact JSON for a page that quizzes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points of a record's context that go with it.
CONTEXT = 700


def _filled(df: DataFrame, name: str) -> Column:
    """A column where df has it and it isn't empty."""
    return F.nullif(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit(None).cast("string")


def compact(df: DataFrame, families: DataFrame | None = None, most: int = CONTEXT) -> DataFrame:
    """id and json of records(id, q, opts, resp, org, fecha), with tema_primario, ambito, categoria_origen and contexto where df has them.

    id, q, o, r, tema, fam, org and a (the year's four characters) are always there, null if unknown; amb,
    cat and ctx only where they are filled, and of ctx the first `most` code points alone. Questions and
    options are whole. families(id, family): the family's number for the records that have one; a family of
    repeated ids is the least. Repeated records give equal rows; an empty table gives none.
    """
    topic = F.col("tema_primario").cast("int") if "tema_primario" in df.columns else F.lit(None).cast("int")
    rows = df.select(
        "id", F.col("q"), F.col("opts").alias("o"), F.col("resp").alias("r"), topic.alias("tema"), F.col("org"), F.nullif(F.left(F.coalesce(F.col("fecha").cast("string"), F.lit("")), F.lit(4)), F.lit("")).alias("a"),
        _filled(df, "ambito").alias("amb"), _filled(df, "categoria_origen").alias("cat"), F.left(_filled(df, "contexto"), F.lit(most)).alias("ctx"),
    )
    if families is None:
        rows = rows.withColumn("fam", F.lit(None).cast("long"))
    else:
        rows = rows.join(families.groupBy("id").agg(F.min("family").cast("long").alias("fam")), "id", "left")
    base = F.to_json(F.struct("id", "q", "o", "r", "tema", "fam", "org", "a"), {"ignoreNullFields": "false"})
    more = F.to_json(F.struct("amb", "cat", "ctx"), {"ignoreNullFields": "true"})
    both = F.concat(F.left(base, F.length(base) - 1), F.lit(","), F.substring(more, F.lit(2), F.length(more)))
    return rows.select("id", F.when(more == "{}", base).otherwise(both).alias("json"))
