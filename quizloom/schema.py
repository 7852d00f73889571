"""The record contract of a question corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LETTERS = ["A", "B", "C", "D"]

RECORD = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("org", T.StringType()), T.StructField("ccaa", T.StringType()),
    T.StructField("fecha", T.StringType()), T.StructField("turno", T.StringType()), T.StructField("num", T.IntegerType()),
    T.StructField("bloque", T.StringType()), T.StructField("q", T.StringType()), T.StructField("opts", T.ArrayType(T.StringType())),
    T.StructField("resp", T.StringType()), T.StructField("resp_verificada", T.BooleanType()), T.StructField("conf", T.DoubleType()),
    T.StructField("origen", T.StringType()), T.StructField("penalizacion", T.DoubleType()), T.StructField("reserva", T.BooleanType()),
])

#: Values that older records lack.
DEFAULTS = {"conf": 1.0, "origen": "html", "revisar": False, "penalizacion": 0.0, "reserva": False}


class CorpusInvalid(ValueError):
    """Records that break the contract."""


def violations(df: DataFrame) -> Column:
    """Array of the rules that a record breaks, in rule order; columns that df lacks count as missing fields."""
    has = set(df.columns)
    col = lambda c, t="string": F.col(c) if c in has else F.lit(None).cast(t)
    verified, resp = col("resp_verificada", "boolean"), col("resp")
    checks = [(~F.lit(f.name in has), f"missing {f.name}") for f in RECORD]
    checks += [
        (col("id").isNull() | (F.trim(col("id")) == ""), "empty id"),
        (col("q").isNull() | (F.trim(col("q")) == ""), "empty stem"),
        (F.coalesce(F.size(col("opts", "array<string>")), F.lit(0)) <= 0, "no options"),
        (verified.isNull(), "verification not boolean"),
        (F.coalesce(verified, F.lit(False)) & ~F.coalesce(resp.isin(LETTERS), F.lit(False)), "verified without a valid letter"),
        (~F.coalesce(verified, F.lit(False)) & resp.isNotNull(), "letter without verification"),
        (col("conf", "double").isNull() | ~col("conf", "double").between(0, 1), "confidence outside 0 to 1"),
        (~F.coalesce(col("penalizacion", "double").between(0, 1), F.lit(True)), "penalty outside 0 to 1"),
        (col("reserva", "boolean").isNull(), "reserve not boolean"),
    ]
    return F.filter(F.array(*[F.when(c, F.lit(m)) for c, m in checks]), lambda x: x.isNotNull())


def with_defaults(df: DataFrame) -> DataFrame:
    """df with missing or null fields filled (a null penalty stays: it means unknown) and changed, whether a row was."""
    changed, out = F.lit(False), df
    if "resp_verificada" not in df.columns:
        out, changed = out.withColumn("resp_verificada", F.col("resp").isin(LETTERS)), F.lit(True)
    for c, v in DEFAULTS.items():
        if c not in df.columns:
            out, changed = out.withColumn(c, F.lit(v)), F.lit(True)
        elif c != "penalizacion":
            changed = changed | F.col(c).isNull()
            out = out.withColumn(c, F.coalesce(c, F.lit(v)))
    before = df.columns
    flag = F.lit(True) if any(c not in before for c in [*DEFAULTS, "resp_verificada"]) else None
    if flag is None:
        flag = F.lit(False)
        for c in DEFAULTS:
            if c != "penalizacion":
                flag = flag | df[c].isNull()
        return df.withColumn("changed", flag).withColumns({c: F.coalesce(c, F.lit(v)) for c, v in DEFAULTS.items() if c != "penalizacion"})
    return out.withColumn("changed", flag)


class Corpus:
    """Records of any verification state; answers can't be analysed from here."""

    def __init__(self, df: DataFrame):
        self.df = df

    @classmethod
    def load(cls, *frames: DataFrame, strict: bool = True) -> Corpus:
        """The union of parts. strict: raises with the first 20 broken or repeated ids."""
        df = frames[0]
        for f in frames[1:]:
            df = df.unionByName(f, allowMissingColumns=True)
        if strict:
            broken = df.withColumn("fails", violations(df)).where(F.size("fails") > 0).select("id", F.array_join("fails", "; ").alias("why"))
            twice = df.groupBy("id").count().where("count > 1").select("id", F.lit("repeated id").alias("why"))
            if found := broken.unionByName(twice).limit(20).collect():
                raise CorpusInvalid("\n".join(f"{r.id}: {r.why}" for r in found))
        return cls(df)

    def verified(self) -> Verified:
        return Verified(self.df.where("resp_verificada"))

    def unverified(self) -> DataFrame:
        return self.df.where(~F.coalesce("resp_verificada", F.lit(False)))


class Verified:
    """Records with a verified answer; each row is checked as it is read."""

    def __init__(self, df: DataFrame):
        ok = F.coalesce(F.col("resp_verificada") & F.col("resp").isin(LETTERS), F.lit(False))
        self.df = df.where(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit("unverified record or bad letter")).cast("boolean")))


def need_verified(c: object) -> DataFrame:
    """The frame of a Verified; TypeError for anything else."""
    if not isinstance(c, Verified):
        raise TypeError("answers can only be analysed on Verified records")
    return c.df
