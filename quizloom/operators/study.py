"""Study planning on a question corpus: weights of evidence, priorities, mastery, validation. These are extensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def likelihood(year: Column, region: Column, kappa: dict[str, float], rate: float = 0.1, now: int = 2026, other: float = 0.5) -> Column:
    """exp(-rate * age) * kappa of the region (other: for regions not named); null without a year, age 0 for later years."""
    near = F.coalesce(*[F.when(region == k, F.lit(v)) for k, v in kappa.items()], F.lit(other))
    return F.exp(-F.lit(rate) * F.greatest(F.lit(now) - year, F.lit(0))) * near


def dirichlet_weights(counts: DataFrame, topics: DataFrame, questions: int, strength: float = 1.0) -> DataFrame:
    """topic, n, expected: (n + a) / (N + sum of a) * questions; a: strength times the topic's share of prior over all, times the number of topics.

    topics: topic, prior. Topics without counts keep their prior; counts of unknown topics don't count.
    """
    w = Window.partitionBy(F.lit(1))  # a row for each topic
    j = topics.join(counts, "topic", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    j = j.withColumn("a", strength * F.col("prior") / F.sum("prior").over(w) * F.count("*").over(w))
    return j.select("topic", "n", ((F.col("n") + F.col("a")) / (F.sum("n").over(w) + F.sum("a").over(w)) * questions).alias("expected"))


def priorities(topics: DataFrame, budget: float) -> DataFrame:
    """topics(topic, expected, hours) by expected / hours: ratio, rank, hours so far, whether they still fit the budget, share of expected so far.

    The ratio orders, the budget cuts. Topics of no hours come first; ties by topic.
    """
    ratio = F.when(F.col("hours") > 0, F.col("expected") / F.col("hours"))
    w = Window.orderBy(F.col("ratio").desc_nulls_first(), "topic")  # a row for each topic
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    t = topics.withColumn("ratio", ratio)
    mass = F.sum("expected").over(so_far) / F.sum("expected").over(Window.partitionBy(F.lit(1)))
    out = t.select("topic", "expected", "hours", "ratio", F.row_number().over(w).cast("long").alias("rank"), F.sum("hours").over(so_far).alias("hours_so_far"), mass.alias("coverage"))
    return out.withColumn("chosen", F.col("hours_so_far") <= budget)


def mark(coverage: Column, studied: float = 0.85, guessed: float = 0.25, total: float = 80.0) -> Column:
    """The mark expected where so much of the mass is covered: total * (C * studied + (1 - C) * guessed)."""
    return total * (coverage * studied + (1 - coverage) * guessed)


def least_coverage(needed: float, studied: float = 0.85, guessed: float = 0.25, total: float = 80.0) -> float:
    """The coverage from which the mark is reached, within 0 and 1."""
    return min(1.0, max(0.0, (needed / total - guessed) / (studied - guessed)))


def mastery(hits: Column, misses: Column, alpha: float = 1.0, beta: float = 1.0) -> Column:
    """Mean of the Beta posterior; without evidence that of the prior."""
    h, m = F.coalesce(hits, F.lit(0)), F.coalesce(misses, F.lit(0))
    return (alpha + h) / (alpha + beta + h + m)


def select_nodes(nodes: DataFrame, k: int) -> DataFrame:
    """The k nodes of highest recurrence * (1 - mastery) * ratio. nodes: node, recurrence, hits, misses, ratio."""
    scored = nodes.withColumn("mastery", mastery(F.col("hits"), F.col("misses")))
    scored = scored.withColumn("score", F.round(F.col("recurrence") * (1 - F.col("mastery")) * F.col("ratio"), 6))
    return scored.orderBy(F.desc("score"), "node").limit(k)


def hold_out(df: DataFrame, last: int, topics: DataFrame, alpha: float = 0.5) -> DataFrame:
    """One row: topic shares fitted up to the year last, held against the year after and against a uniform study.

    n_fit, n_test, error and error_uniform (sum over topics of |predicted - met| questions), beats. df: topic, year.
    """
    per = df.where(F.col("year") <= last + 1).groupBy("topic").agg(F.count_if(F.col("year") <= last).alias("fit"), F.count_if(F.col("year") == last + 1).alias("met"))
    w = Window.partitionBy(F.lit(1))  # a row for each topic
    j = topics.select("topic").join(per, "topic", "left").fillna(0, ["fit", "met"])
    size, n = F.count("*").over(w), F.sum("met").over(w)
    j = j.select("fit", "met", ((F.col("fit") + alpha) / (F.sum("fit").over(w) + alpha * size) * n).alias("predicted"), (n / size).alias("uniform"))
    out = j.agg(F.sum("fit").alias("n_fit"), F.sum("met").alias("n_test"), F.round(F.sum(F.abs(F.col("predicted") - F.col("met"))), 6).alias("error"), F.round(F.sum(F.abs(F.col("uniform") - F.col("met"))), 6).alias("error_uniform"))
    return out.withColumn("beats", F.col("error") < F.col("error_uniform"))


def mostly_specific(df: DataFrame, group: str, common: Column, most: float = 0.25) -> DataFrame:
    """group, n, common_share and kept: groups with more than such a share of common questions don't count."""
    per = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(common).alias("c"))
    return per.select(group, "n", F.round(F.col("c") / F.col("n"), 6).alias("common_share"), (F.col("c") / F.col("n") <= most).alias("kept"))


def file_report(df: DataFrame, file: str, num: str, fails: Column | None = None) -> DataFrame:
    """file, expected (its greatest number), extracted (different numbers), n_fails and state: one fault or gap holds the whole file back."""
    bad = F.count_if(fails) if fails is not None else F.lit(0).cast("long")
    per = df.groupBy(file, num).agg(bad.alias("f"))
    out = per.groupBy(file).agg(F.max(num).cast("long").alias("expected"), F.count(num).alias("extracted"), F.sum("f").alias("n_fails"))
    whole = (F.col("expected") == F.col("extracted")) & (F.col("n_fails") == 0)
    return out.withColumn("state", F.when(whole, F.lit("clean")).otherwise(F.lit("quarantine")))
