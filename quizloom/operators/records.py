"""Relational steps on records: splits, joins, upserts, orders within groups.

Unless a function says otherwise: all columns pass, whatever their names (helpers take names of their own, results
replace columns of theirs); repeated rows stay as often as they are there; a null group is a group, a null key of a
join finds nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizloom.functions.names import fresh


def first_wins(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the order given; of rows that tie, that of the least hash. A null key is a key.

    A least row is kept for each key before anything is shuffled, so a key that most rows have costs a row a
    task. Repeated rows give one; columns may have any name; an empty table gives no rows.
    """
    (row,) = fresh(df, "row")
    whole = [F.col(f"`{c}`") for c in df.columns]
    least = df.groupBy(*by).agg(F.min_by(F.struct(*whole), F.struct(*order, F.xxhash64(*whole))).alias(row))
    return least.select(f"`{row}`.*")


def new_and_collided(new: DataFrame, known: DataFrame, by: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows to append (the first of each key that isn't known), and all others: known, or not the first of their batch.

    A null key is a key, known if a known row has it. Both together are the rows of new, repeated ones as often
    as they are there. Columns may have any name; empty tables give no rows.
    """
    (k,) = fresh(new, "k")
    there = known.select(F.col(by).alias(k)).distinct()
    rows = first_wins(new, [by], order).join(there, F.col(f"`{by}`").eqNullSafe(F.col(k)), "left_anti")
    return rows, new.exceptAll(rows)


def quarantine(df: DataFrame, fails: str = "fails") -> tuple[DataFrame, DataFrame]:
    """Clean rows, and rows with faults. Being quarantined says nothing about verification."""
    return df.where(F.size(fails) == 0), df.where(F.size(fails) > 0)


def with_answers(questions: DataFrame, grid: DataFrame, on: str = "num") -> DataFrame:
    """Each question with its answer; none in the grid: null and unverified."""
    return questions.join(grid.select(on, "resp"), on, "left").withColumn("resp_verificada", F.col("resp").isNotNull())


def upsert(base: DataFrame, rectified: DataFrame, on: str = "num") -> DataFrame:
    """Grid with non-null rectifications over it, and those of new numbers."""
    r = rectified.select(on, F.col("resp").alias("new"))
    return base.select(on, "resp").join(r, on, "full").select(on, F.coalesce("new", "resp").alias("resp"))


def gaps(df: DataFrame, group: str, num: str) -> DataFrame:
    """Numbers missing between a group's least and greatest."""
    span = df.groupBy(group).agg(F.min(num).alias("a"), F.max(num).alias("b"))
    every = span.select(group, F.explode(F.sequence("a", "b")).alias(num))
    return every.join(df.select(group, num).distinct(), [group, num], "left_anti")


def lookup(df: DataFrame, index: DataFrame, key_left, key_right, order: list[str]) -> DataFrame:
    """Left join by exact key, the index row that comes first winning; a null key finds nothing."""
    k, mine = fresh(df, "k", "mine", also=index.columns)
    right = first_wins(index.withColumn(k, key_right), [k], order)
    both = df.withColumn(mine, key_left).join(right, F.col(mine) == F.col(k), "left")
    return both.drop(k, mine)


def carry_forward(df: DataFrame, group: str, order: str, value, name: str) -> DataFrame:
    """The last non-null value at or before each row of its group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def blocks(df: DataFrame, group: str, order: str, opens, text: str) -> DataFrame:
    """Lines merged into the block that the last opening line began: group, block, first, n, text. Lines before any are block 0."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = df.withColumn("block", F.sum(F.when(opens, 1).otherwise(0)).over(w))
    lines = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return numbered.groupBy(group, "block").agg(F.min(order).alias("first"), F.count("*").alias("n"), F.array_join(F.transform(lines, lambda x: x.t), " ").alias("text"))


def islands(df: DataFrame, group: str, order: str, gap) -> DataFrame:
    """Rows numbered by island: a new one begins where gap(previous, current) holds."""
    w = Window.partitionBy(group).orderBy(*([order] if isinstance(order, str) else order))
    jump = F.when(gap(F.lag(F.col(order if isinstance(order, str) else order[0])).over(w), F.col(order if isinstance(order, str) else order[0])), 1).otherwise(0)
    (j,) = fresh(df, "jump")
    return df.withColumn(j, jump).withColumn("island", F.sum(j).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop(j)


def whole_groups(df: DataFrame, group: str, ok) -> DataFrame:
    """Rows of groups all of whose rows hold ok."""
    (every,) = fresh(df, "every")
    good = df.groupBy(group).agg(F.bool_and(F.coalesce(ok, F.lit(False))).alias(every)).where(F.col(every)).select(group)
    return df.join(good, group, "left_semi")


def hash_sample(df: DataFrame, column: str, k: int, seed: int = 1) -> DataFrame:
    """k rows in the order of a seeded hash: reruns agree."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}-"), F.col(column).cast("string")).cast("binary")), column).limit(k)
