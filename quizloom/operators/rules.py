"""Rules as data: a table of patterns compiled to one expression, and staged rules over terms with joint conditions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.names import fresh
from quizloom.functions.text import evidence, fold
from quizloom.operators.terms import Terms

#: Rules that a table may have: they become one expression.
MOST = 5_000


class Rule(NamedTuple):
    """One staged rule: it holds for a text that has, of each group, any term. {} in the reason stands for the first term in the order of the first group that the text has."""

    stage: str
    topic: int
    groups: list[list[str]]
    reason: str


def _rows(table: DataFrame, *columns: str) -> list:
    rows = table.select(*columns).orderBy(*columns).limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"more than {MOST} rules")
    return rows


class PatternRules:
    """Patterns over the folded stem, in order; the first that matches decides. Read from a table(ord, name, pattern, topic); equal orders go by name."""

    def __init__(self, rules: list[tuple[str, str, int]]):
        self.rules = rules

    @classmethod
    def of(cls, table: DataFrame) -> PatternRules:
        return cls([(r.name, r.pattern, r.topic) for r in _rows(table, "ord", "name", "pattern", "topic")])

    def matches(self, stem: Column) -> Column:
        """array<int>: the places of all rules that match; none for a null stem."""
        each = [F.when(F.regexp_like(stem, F.lit(p)), F.lit(i)) for i, (_, p, _) in enumerate(self.rules)]
        return F.array_compact(F.array(*each)) if each else F.array().cast("array<int>")

    def first(self, matches: Column) -> Column:
        """struct(name, topic) of the first match; null if there is none."""
        table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).cast("int").alias("topic")) for n, _, t in self.rules])
        return F.get(table, F.get(matches, F.lit(0))) if self.rules else F.lit(None).cast("struct<name:string,topic:int>")

    def apply(self, df: DataFrame, q: str = "q") -> DataFrame:
        """df with rule, topic and evidence (the text around the match) of the first rule that matches; nulls where none does. They replace columns of those names."""
        stem, hit, all_ = fresh(df, "stem", "hit", "all")
        out = df.withColumn(stem, fold(F.col(q))).withColumn(all_, self.matches(F.col(stem)))
        out = out.withColumn(hit, self.first(F.col(all_)))
        shown = [F.when(F.get(F.col(all_), F.lit(0)) == i, evidence(F.col(q), F.col(stem), p, 25, 45)) for i, (_, p, _) in enumerate(self.rules)]
        text = F.coalesce(*shown) if shown else F.lit(None).cast("string")
        return out.withColumns({"rule": F.col(hit)["name"], "topic": F.col(hit)["topic"], "evidence": text}).drop(stem, hit, all_)

    def report(self, df: DataFrame, q: str = "q") -> DataFrame:
        """ord (from 1), name, topic, hits (rows that the rule decides) and shadowed (rows it matches but an earlier rule decides) of every rule, also of those that match nothing."""
        spark = df.sparkSession
        m = df.select(F.posexplode(self.matches(fold(F.col(q)))).alias("at", "i"))
        per = m.groupBy("i").agg(F.count_if(F.col("at") == 0).alias("hits"), F.count_if(F.col("at") > 0).alias("shadowed"))
        every = spark.createDataFrame([(i, n, t) for i, (n, _, t) in enumerate(self.rules)], "i int, name string, topic int")
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        return every.join(per, "i", "left").select((F.col("i") + 1).alias("ord"), "name", "topic", zero("hits"), zero("shadowed"))


def staged_rules(table: DataFrame) -> list[Rule]:
    """Rules of a table(stage_order, stage, ord, topic, groups array<array<string>>, reason), in order."""
    rows = _rows(table, "stage_order", "ord", "stage", "topic", "groups", "reason")
    return [Rule(r.stage, r.topic, [list(g) for g in r.groups], r.reason) for r in rows]


def decide(df: DataFrame, rules: list[Rule], q: str = "q", opts: str = "opts", none: str = "no sign") -> DataFrame:
    """df with topic, stage, reason and scope ('stem' or 'all'; null where no rule holds, then reason is that of none).

    Rules are tried in order, all stages on the stem; only where none holds, all again on stem and options
    (joined by ||, options by |). A null stem or options are empty; a rule with an empty group never holds, one without groups
    always does. All terms are looked for in one pass of a text, and the second text is only read where it is
    needed. topic, stage, reason and scope replace columns of those names.
    """
    spark: SparkSession = df.sparkSession
    terms = Terms(spark, [t for r in rules for g in r.groups for t in g])
    numbers = [[[terms.number[t] for t in g if t in terms.number] for g in r.groups] for r in rules]
    ints = lambda g: F.array(*map(F.lit, g)).cast("array<int>")
    groups = lambda gs: F.array(*map(ints, gs)).cast("array<array<int>>")
    each = [F.struct(F.lit(r.topic).cast("int").alias("topic"), F.lit(r.stage).alias("stage"), F.lit(r.reason).alias("reason"), groups(n).alias("groups")) for r, n in zip(rules, numbers)]
    table = F.array(*each)
    stem, full, hits, more, won, late = fresh(df, "stem", "full", "hits", "more", "won", "late")
    text = F.coalesce(F.col(q), F.lit(""))
    every = F.concat(text, F.lit(" || "), F.coalesce(F.array_join(opts, " | "), F.lit("")))
    first = lambda h: F.get(F.filter(table, lambda r: F.forall(r["groups"], lambda g: F.arrays_overlap(g, h))), F.lit(0)) if each else F.lit(None).cast("struct<topic:int,stage:string,reason:string,groups:array<array<int>>>")

    def told(win: Column, h: Column) -> Column:
        term = F.get(F.filter(F.get(win["groups"], F.lit(0)), lambda i: F.array_contains(h, i)), F.lit(0))
        name = F.get(F.lit(list(terms.terms)), term) if terms.terms else F.lit(None).cast("string")
        return F.replace(win["reason"], F.lit("{}"), F.coalesce(name, F.lit("")))

    out = df.withColumn(stem, fold(text)).withColumn(hits, terms.hits(F.col(stem)))
    out = out.withColumn(won, first(F.col(hits)))
    out = out.withColumn(full, F.when(F.col(won).isNull(), fold(every))).withColumn(more, terms.hits(F.col(full)))
    out = out.withColumn(late, F.when(F.col(won).isNull(), first(F.col(more))))
    either = lambda a, b: F.when(F.col(won).isNotNull(), a).when(F.col(late).isNotNull(), b)
    out = out.withColumns({
        "topic": either(F.col(won)["topic"], F.col(late)["topic"]), "stage": either(F.col(won)["stage"], F.col(late)["stage"]),
        "reason": F.coalesce(either(told(F.col(won), F.col(hits)), told(F.col(late), F.col(more))), F.lit(none)), "scope": either(F.lit("stem"), F.lit("all")),
    })
    return out.drop(stem, full, hits, more, won, late)


def agreement(gold: DataFrame, predicted: DataFrame, on: str = "id") -> DataFrame:
    """ok, wrong, undecided, missing, decided, total, agreement, coverage: predictions (topic) against gold (topic, second; either will do).

    A gold row without a prediction's row is missing and in no other count; shares of nothing are 0.
    """
    p, there = fresh(gold, "p", "there")
    j = gold.join(predicted.select(on, F.col("topic").alias(p), F.lit(True).alias(there)), on, "left")
    hit = F.coalesce((F.col(p) == F.col("topic")) | F.coalesce(F.col(p) == F.col("second"), F.lit(False)), F.lit(False))
    counts = j.agg(
        F.count_if(hit).alias("ok"), F.count_if(F.col(p).isNotNull() & ~hit).alias("wrong"),
        F.count_if(F.col(there).isNotNull() & F.col(p).isNull()).alias("undecided"), F.count_if(F.col(there).isNull()).alias("missing"),
    )
    decided = F.col("ok") + F.col("wrong")
    total = decided + F.col("undecided")
    share = lambda a, b: F.round(a / F.greatest(b, F.lit(1)), 6)
    return counts.select("ok", "wrong", "undecided", "missing", decided.alias("decided"), total.alias("total"), share(F.col("ok"), decided).alias("agreement"), share(decided, total).alias("coverage"))
