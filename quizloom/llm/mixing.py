"""Mixing sources to target weights by weighted fair queueing.

Each source queues its documents in a shuffled order (md5 of seed and doc_id) and then, once
more, the same order again, as no document may be taken more than twice. A document's virtual
finish time is its source's running size, up to and with the document, over the source's
target. Documents leave in order of finish time until the budget, the sum of all targets, is
used. Only ids, sources and sizes are shuffled, never texts.

Running sums are two-level: sizes are added up for each (source, leading digits of the shuffle
key), the small table of those sums is scanned, and a window runs within one such bucket. So a
source that holds most rows is spread over 16**digits buckets. The cut at the budget works the
same way over slices of finish time.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import fresh
from quizloom.session import cut

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
#: Rows that a bucket of running sums is meant to hold.
BUCKET_ROWS = 20_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and size (words; null text: 0), and the shuffle key, of every row."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return docs.select("doc_id", "source", size.alias("size"), key.alias("key"))


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target: weights 5, 2, 1 by code point order (null last), capped at twice the size.

    The cap's excess goes to the others by weight until none is above: with sources in order of
    2 * size / weight, those before the first whose share stays within its cap get their cap.
    One row a source; the windows below run over that small table.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("w", F.element_at(F.lit(list(WEIGHTS)), ((rank - 1) % len(WEIGHTS) + 1).cast("int")).cast("double"))
    per = per.withColumn("cap", (MOST * F.col("source_size")).cast("double")).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    left = SHARE * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    level = left / F.sum("w").over(rest)
    per = per.withColumn("level", F.when(level <= F.col("ratio"), level))
    per = per.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    share = F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return per.select("source", "source_size", share.alias("target"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) of every row of docs(doc_id, text, source).

    taken is 0, 1 or 2 times size. Each source's taken words come within its largest document of
    its target. Reruns agree: the order depends on seed and ids alone; repeated ids are ordered
    by size, and equal rows are interchangeable. A null text has size 0, a null source is a
    source of its own, a null id hashes as the empty text. Empty tables give no rows.
    """
    sized = cut(sizes(docs), "sizes")
    rows, digits = sized.count(), 0
    while 16**digits * BUCKET_ROWS < rows and digits < 6:
        digits += 1
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    goal = targets(sized)
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("s"))
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("base", F.coalesce(F.sum("s").over(ahead), F.lit(0)))
    start = sums.withColumnRenamed("source", "gs").join(goal, F.expr("source <=> gs")).select("gs", F.col("bucket").alias("gb"), "base", "source_size", "target")
    row = Window.partitionBy("source", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = sized.withColumn("run", F.sum("size").over(row)).join(start, F.expr("source <=> gs AND bucket = gb"))
    queued = cut(queued.withColumn("run", F.col("run") + F.col("base")).select("doc_id", "source", "size", "key", "run", "source_size", "target"), "mix")

    def finish(turn):
        return F.when(F.col("target") > 0, (F.col("run") + turn * F.col("source_size")) / F.col("target")).otherwise(F.lit(0.0))

    slices = min(65536, max(256, rows // BUCKET_ROWS))
    turns = queued.select("key", "size", F.explode(F.array(*[F.struct(finish(t).alias("finish"), F.lit(t).alias("turn")) for t in range(MOST)])).alias("t"))
    turns = turns.select("key", "size", "t.finish", "t.turn", F.least(F.floor(F.col("t.finish") * (slices / 2)), F.lit(slices)).alias("slice"))
    budget = math.floor((goal.agg(F.sum("target")).first()[0] or 0.0) + 1e-6)
    spent, at = 0, None
    for at, s in sorted(turns.groupBy("slice").agg(F.sum("size")).collect()):  # slices + 1 rows at most
        if spent + s > budget:
            break
        spent += s
    else:
        at = None
    item = ["finish", "key", "size", "turn"]
    if at is None:
        taken = MOST * F.col("size")
    else:
        upto = Window.partitionBy("slice").orderBy(*item).rangeBetween(Window.unboundedPreceding, Window.currentRow)
        fits = turns.where(F.col("slice") == at).withColumn("sum", F.sum("size").over(upto)).where(F.col("sum") <= budget - spent)
        last = fits.agg(F.max(F.struct(*item)).alias("m")).first().m
        if last is None:  # nothing of that slice fits: all before it goes
            went = [finish(t) * (slices / 2) < at for t in range(MOST)]
        else:
            end = F.struct(*[F.lit(last[c]).alias(c) for c in item])
            went = [F.struct(finish(t).alias("finish"), "key", "size", F.lit(t).alias("turn")) <= end for t in range(MOST)]
        taken = sum(F.when(w, F.col("size")).otherwise(0) for w in went)
    return queued.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def repeat_taken(docs: DataFrame) -> DataFrame:
    """The rows of docs as often as the mix takes them; rows of size 0 (empty and null texts) are never taken and go.

    Rows of one doc_id and size share their copies: each goes out the floor of its share, the rest in
    order of source and text. A null id is an id. Columns are those of docs, of any name and type;
    an empty table gives no rows.
    """
    ident, own, size, times, n, place, copies = fresh(docs, "ident", "own", "size", "times", "n", "place", "copies")
    mixed = mix(docs).where("taken > 0").groupBy("doc_id", "size").agg(F.sum("taken").alias("all"), F.count("*").alias("rows"))
    taken = mixed.select(F.col("doc_id").alias(ident), F.col("size").alias(size), F.expr("cast(all div size as int)").alias(times), F.col("rows").cast("int").alias(n))
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    named = docs.withColumn(own, words).join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col(ident)) & (F.col(own) == F.col(size)))
    order = Window.partitionBy("doc_id", own).orderBy("source", "text")
    named = named.withColumn(place, F.when(F.col(n) == 1, F.lit(1)).otherwise(F.row_number().over(order)))
    each = F.floor(F.col(times) / F.col(n)).cast("int") + F.when(F.col(place) <= F.col(times) % F.col(n), 1).otherwise(0)
    named = named.withColumn(copies, each).where(F.col(copies) > 0)
    return named.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
