"""Inventories, totals and reports of ingested papers, and the joins between papers, grids and families.

Null groups are groups of their own unless stated; repeated rows count each; empty tables give no
groups, and totals of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of the expected marks that a downloaded page must hold.
ENOUGH = 0.5


def section_inventory(df: DataFrame, section: str = "section", num: str = "num") -> DataFrame:
    """section, n, low, high: how many questions each section has, and its least and greatest number."""
    return df.groupBy(section).agg(F.count("*").alias("n"), F.min(num).alias("low"), F.max(num).alias("high"))


def confidence_summary(df: DataFrame, conf: str = "conf", most: float = 0.99) -> DataFrame:
    """n, mean, least of confidences, each taken as at most `most`; null ones don't count, and of none the mean is 0."""
    c = F.least(F.col(conf), F.lit(most))
    return df.agg(F.count(conf).alias("n"), F.coalesce(F.avg(F.when(F.col(conf).isNotNull(), c)), F.lit(0.0)).alias("mean"), F.coalesce(F.min(F.when(F.col(conf).isNotNull(), c)), F.lit(0.0)).alias("least"))


def distinct_facts(df: DataFrame, fact: str) -> DataFrame:
    """n, n_facts: rows, and distinct facts among them; null is no fact."""
    return df.agg(F.count("*").alias("n"), F.count_distinct(F.col(fact)).alias("n_facts"))


def download_states(pages: DataFrame, html: str, mark: str, expected: int) -> DataFrame:
    """pages with kb, marks and state of each: whether it holds enough marks; a null page failed."""
    kb = F.coalesce(F.floor(F.octet_length(html) / 1024), F.lit(0)).cast("long")
    marks = F.coalesce((F.length(html) - F.length(F.replace(F.col(html), F.lit(mark), F.lit("")))) / len(mark), F.lit(0)).cast("long")
    state = F.when(F.col(html).isNull(), F.lit("FAILED")).when(marks >= expected * ENOUGH, F.lit("OK")).otherwise(F.lit("FAILED: no marks"))
    return pages.withColumns({"kb": kb, "marks": marks, "state": state})


def download_totals(states: DataFrame) -> DataFrame:
    """state, n, kb, marks of download_states(), by state."""
    return states.groupBy("state").agg(F.count("*").alias("n"), F.sum("kb").alias("kb"), F.sum("marks").alias("marks"))


def with_families(questions: DataFrame, families: DataFrame, ident: str = "id") -> DataFrame:
    """questions with fam, the family whose members name it; of several the last by number; null if none. families: family, members."""
    member = families.select(F.col("family").alias("fam"), F.explode("members").alias(ident)).groupBy(ident).agg(F.max("fam").alias("fam"))
    return questions.join(member, ident, "left")


def payload_meta(questions: DataFrame, topic: str = "topic", family: str = "fam") -> DataFrame:
    """n, with_topic, with_family, families of the questions that go out; topic 0 counts as none."""
    return questions.agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col(topic), F.lit(0)) != 0).alias("with_topic"), F.count(family).alias("with_family"), F.count_distinct(family).alias("families"))


def unmatched(paper: DataFrame, answers: DataFrame, on: str = "num") -> DataFrame:
    """num, side: numbers of the paper without an answer, and of the grid without a question; nulls are left out."""
    p, g = (d.select(on).where(F.col(on).isNotNull()).distinct() for d in (paper, answers))
    left = p.join(g, on, "left_anti").withColumn("side", F.lit("no answer"))
    return left.unionByName(g.join(p, on, "left_anti").withColumn("side", F.lit("no question")))


def category_states(questions: DataFrame, grid: DataFrame, limit: int, by: str = "category", num: str = "num") -> DataFrame:
    """by, state, numbers: whether a category may be taken in as a whole.

    'no grid' if it has no answers at all; 'gaps' if a number from 1 to limit is missing in the paper;
    'outside' if a number of the paper isn't in its grid (the first six are shown); else 'complete'.
    Only categories of questions appear; of each, sets of numbers meet in one row, bounded by a paper's length.
    """
    q = questions.groupBy(by).agg(F.collect_set(num).alias("asked"))
    g = grid.groupBy(by).agg(F.collect_set(num).alias("known"))
    both = q.join(g, by, "left")
    gaps = F.array_except(F.sequence(F.lit(1), F.lit(limit)).cast("array<long>"), F.col("asked").cast("array<long>"))
    outside = F.slice(F.array_sort(F.array_except(F.col("asked").cast("array<long>"), F.coalesce("known", F.array()).cast("array<long>"))), 1, 6)
    state = F.when(F.col("known").isNull(), F.lit("no grid")).when(F.size(gaps) > 0, F.lit("gaps")).when(F.size(outside) > 0, F.lit("outside")).otherwise(F.lit("complete"))
    shown = F.when(state == "gaps", F.array_sort(gaps)).when(state == "outside", outside).otherwise(F.array().cast("array<long>"))
    return both.select(by, state.alias("state"), F.array_join(shown.cast("array<string>"), ",").alias("numbers"))


def complete_only(questions: DataFrame, grid: DataFrame, limit: int, by: str = "category", num: str = "num") -> DataFrame:
    """Questions of the categories that category_states() calls complete."""
    ok = category_states(questions, grid, limit, by, num).where("state = 'complete'").select(by)
    return questions.join(ok, by, "left_semi")


def rejects(pages: DataFrame, title: Column, pattern: str, ident: str) -> DataFrame:
    """ident, title, reason of pages to set aside: without a readable title, or of another category. Nothing is moved."""
    t = pages.select(ident, F.coalesce(title, F.lit("")).alias("title"))
    why = F.when(F.trim("title") == "", F.lit("no title")).when(~F.regexp_like("title", F.lit(pattern)), F.lit("other category"))
    return t.withColumn("reason", why).where("reason IS NOT NULL")


def report(df: DataFrame, form: str, *columns: str) -> DataFrame:
    """line: a text line for each row of a metric, columns put into the printf form; null shows as 'null'."""
    return df.select(F.format_string(form, *columns).alias("line"))


def write_report(parts: list[tuple[str, DataFrame]], path: str) -> str:
    """A text report of metrics: each a heading and its lines in order, written to path by the driver; metrics are small tables."""
    text = "\n\n".join("\n".join([f"== {head} ==", *sorted(r.line for r in lines.collect())]) for head, lines in parts) + "\n"
    spark = parts[0][1].sparkSession
    spark.createDataFrame([(text.removesuffix("\n"),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text
