"""Topics of texts: ordered rules on the stem, then a weighted lexicon with abstention; and its evaluation.

Null texts match nothing; texts of any length are read whole; repeated rows give equal rows; all columns pass
and results replace columns of their names; an empty table gives no rows, or zeros where the answer is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quizloom.functions.names import fresh
from quizloom.functions.text import evidence, fold
from quizloom.operators.terms import MOST, Terms

Rule = tuple[str, str, int]


def first_rule(stem: Column, rules: list[Rule]) -> Column:
    """The first rule that matches the folded stem: struct(name, pattern, topic); null if none."""
    each = [F.when(F.regexp_like(stem, F.lit(p)), F.struct(F.lit(n).alias("name"), F.lit(t).alias("topic"))) for n, p, t in rules]
    return F.coalesce(*each) if each else F.lit(None).cast("struct<name:string,topic:int>")


class Lexicon:
    """Weighted terms of topics, from a dict of lists or a table(topic, term, weight); topics in the dict's order, or by number.

    A term's weight counts where the stem has it; else 1 where the options have it and its weight is 2 or
    more. Presence counts, not frequency. A term that a topic names twice counts twice, as two rows would.
    """

    def __init__(self, spark: SparkSession, topics: dict[int, list[tuple[str, int]]]):
        self.topics = {t: [(term, w) for term, w in terms if term] for t, terms in topics.items()}
        self.terms = Terms(spark, [term for terms in self.topics.values() for term, _ in terms])

    @classmethod
    def of(cls, table: DataFrame) -> Lexicon:
        rows = table.select(F.col("topic").cast("int").alias("topic"), "term", F.col("weight").cast("int").alias("weight")).where("topic IS NOT NULL AND weight IS NOT NULL").orderBy("topic", "term", "weight").limit(MOST + 1).collect()
        if len(rows) > MOST:
            raise ValueError(f"more than {MOST} terms")
        topics: dict[int, list[tuple[str, int]]] = {}
        for r in rows:
            topics.setdefault(r.topic, []).append((r.term, r.weight))
        return cls(table.sparkSession, topics)

    def scores(self, stem_hits: Column, option_hits: Column) -> Column:
        """array of struct(neg, order, topic), best first, of the topics with points. Each hit's points are looked up by its number and added up by topic."""
        shares: list[list[tuple[int, int, int]]] = [[] for _ in self.terms.terms]
        for order, terms in enumerate(self.topics.values()):
            for term, w in terms:
                if term in self.terms.number:
                    shares[self.terms.number[term]].append((order, w, int(w >= 2)))
        if not any(shares):
            return F.array().cast("array<struct<neg:int,order:int,topic:int>>")
        each = (", ".join(f"named_struct('order', {o}, 'w', {w}, 'half', {h})" for o, w, h in s) for s in shares)
        table = F.expr("array(" + ", ".join(f"array({s})" for s in each) + ")")  # folded to one constant
        own = F.flatten(F.transform(stem_hits, lambda i: F.transform(F.get(table, i), lambda s: F.struct(s.order.alias("order"), s.w.alias("p")))))
        other = F.flatten(F.transform(F.array_except(option_hits, stem_hits), lambda i: F.transform(F.get(table, i), lambda s: F.struct(s.order.alias("order"), s.half.alias("p")))))
        got = F.concat(own, other)
        number = F.lit(list(self.topics))
        per = F.transform(F.array_distinct(F.transform(got, lambda s: s.order)), lambda o: F.struct((-F.aggregate(F.filter(got, lambda s: s.order == o), F.lit(0), lambda n, s: n + s.p)).alias("neg"), o.alias("order"), F.get(number, o).alias("topic")))
        return F.array_sort(F.filter(per, lambda s: s.neg < 0))


def classify(df: DataFrame, rules: list[Rule], lexicon: Lexicon | dict[int, list[tuple[str, int]]], q: str = "q", opts: str = "opts") -> DataFrame:
    """df with topic, second_topic and why. A rule settles the topic; else the lexicon's best of at least 2 points,
    abstaining (topic null, the best as second) where it leads by less than 1.

    A null or empty stem matches no rule and has no points of its own; null options are empty. Ties go to the
    topic that comes first; repeated rows give equal rows; the three columns replace those of the same names.
    """
    if isinstance(lexicon, dict):
        lexicon = Lexicon(df.sparkSession, lexicon)
    stem, options, in_stem, in_options, rule, s = fresh(df, "stem", "options", "in_stem", "in_options", "rule", "s")
    out = df.withColumns({stem: fold(F.col(q)), options: fold(F.coalesce(F.array_join(opts, " "), F.lit("")))})
    out = out.withColumn(rule, first_rule(F.col(stem), rules))
    open_ = F.col(rule).isNull()  # only such texts are read by the automaton
    out = out.withColumns({in_stem: lexicon.terms.hits(F.when(open_, F.col(stem))), in_options: lexicon.terms.hits(F.when(open_, F.col(options)))})
    out = out.withColumn(s, lexicon.scores(F.col(in_stem), F.col(in_options)))
    best, second = F.get(F.col(s), F.lit(0)), F.get(F.col(s), F.lit(1))
    points = -best["neg"]
    lead = points + F.coalesce(second["neg"], F.lit(0))
    sure = (points >= 2) & (lead >= 1)
    topic = F.coalesce(F.col(rule)["topic"], F.when(sure, best["topic"]))
    other = F.when(~open_, F.lit(None).cast("int")).when(points >= 2, second["topic"])
    why = F.when(~open_, F.concat(F.lit("rule:"), F.col(rule)["name"])).when(best.isNull(), F.lit("none")).when(points < 2, F.lit("weak")).when(lead < 1, F.lit("tie")).otherwise(F.concat(F.lit("lexicon:"), points.cast("string")))
    return out.withColumns({"topic": topic.cast("int"), "second_topic": other.cast("int"), "why": why}).drop(stem, options, in_stem, in_options, rule, s)


def rule_cascade(df: DataFrame, stages: list[list[Rule]], q: str = "q", opts: str = "opts") -> DataFrame:
    """The other engine: stages of rules in order, each on the stem alone; then all again on stem and options."""
    stem = fold(q)
    full = fold(F.concat_ws(" ", q, F.array_join(opts, " ")))
    flat = [r for s in stages for r in s]
    return df.withColumn("topic", F.coalesce(first_rule(stem, flat), first_rule(full, flat))["topic"])


def scope(df: DataFrame, pattern: str, q: str = "q") -> DataFrame:
    """in_scope, and the text around the first match."""
    (f,) = fresh(df, "f")
    df = df.withColumn(f, fold(F.col(q)))
    return df.withColumns({"in_scope": F.regexp_like(F.col(f), F.lit(pattern)), "evidence": evidence(F.col(q), F.col(f), pattern)}).drop(f)


def foreign(stem: Column, foreign_pattern: str, home_pattern: str, legal_pattern: str) -> Column:
    """Whether a text is about another region's law and not the home region's."""
    return F.regexp_like(stem, F.lit(foreign_pattern)) & ~F.regexp_like(stem, F.lit(home_pattern)) & F.regexp_like(stem, F.lit(legal_pattern))


def evaluate(gold: DataFrame, predicted: DataFrame, on: str = "id") -> DataFrame:
    """total, missing, covered, agree, agree_or_second; gold: topic (and second), predicted: topic. A null gold topic agrees with nothing."""
    p, there = fresh(gold, "p", "there")
    j = gold.join(predicted.select(on, F.col("topic").alias(p), F.lit(True).alias(there)), on, "left")
    said = F.col(p)
    return j.agg(
        F.count("*").alias("total"), F.count_if(F.col(there).isNull()).alias("missing"), F.count_if(said.isNotNull()).alias("covered"),
        F.count_if(said == F.col("topic")).alias("agree"), F.count_if((said == F.col("topic")) | (said == F.col("second"))).alias("agree_or_second"),
    )


def confusions(gold: DataFrame, predicted: DataFrame, k: int = 8, on: str = "id") -> DataFrame:
    """topic, p, n: the k most frequent confusions; ties by topic, then p."""
    j = gold.select(on, "topic").join(predicted.select(on, F.col("topic").alias("p")), on).where("p IS NOT NULL AND p <> topic")
    return j.groupBy("topic", "p").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "topic", "p").limit(k)
