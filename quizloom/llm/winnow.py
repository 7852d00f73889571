"""Document fingerprints by winnowing, in DataFrame functions only.

A text's characters are taken without white space. Of all runs of K characters a rolling hash is
taken: a polynomial over bits of the codes of its two halves, runs of RUN characters, which every
position shares with that RUN characters on. A run's code is 64 random bits, the hash of its slice
of the text in UTF-32, where each character has as many bytes and a slice costs no search. Of each window of W
neighbouring hashes the least is kept, the rightmost of equals, with its position. Two texts that
share K + W - 1 characters in a row therefore share a kept hash, wherever in either text they stand.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a run (twelve: two of RUN) and hashes of a window (eight: two parts of STEP).
K, W, STEP, RUN = 12, 8, 4, 6
#: Rows that a bucket of neighbours is meant to hold, and most buckets: beyond that they grow, and spill.
BUCKET_ROWS, MOST_BUCKETS = 2000, 1 << 18
_PLACES = 1 << 31
#: Bytes of a character in UTF-32, and what stands for each that a text under K lacks: no character has it.
WIDE, ABSENT = 4, b"\xff"


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def solid(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", "")


def kept(text: Column) -> Column:
    """Kept hashes with their positions, by position: array of (signed 33-bit hash * 2**31 + 2**31 - 1 - position)."""
    return kept_of(solid(text))


def kept_of(bare: Column) -> Column:
    """kept() of a text without white space."""

    def wide(t: Column) -> Column:
        return F.rpad(t, F.greatest(F.octet_length(t), F.lit(K * WIDE)), F.lit(ABSENT))

    def codes(t: Column) -> Column:
        at = F.sequence(F.lit(1), F.octet_length(t) - (RUN * WIDE - 1), F.lit(WIDE))
        return F.transform(at, lambda x: F.xxhash64(F.substring(t, x, F.lit(RUN * WIDE))))

    def grams(h: Column) -> Column:  # beyond the end: null, here and below, which least passes over
        gram = lambda x, i: F.shiftleft(x, RUN).bitwiseXOR(F.get(h, i + RUN))
        return F.transform(h, lambda x, i: F.shiftleft(gram(x, i), 31).bitwiseXOR(F.bitwise_not(i).cast("long")))

    def least_parts(p: Column) -> Column:
        return F.transform(p, lambda x, i: F.least(x, *[F.get(p, i + j) for j in range(1, STEP)]))

    def least(m: Column) -> Column:
        return F.transform(m, lambda x, i: F.least(x, *[F.get(m, i + j) for j in range(STEP, W, STEP)]))

    value = F.encode(bare, "UTF-32")
    for step in (wide, codes, grams, least_parts, least):
        value = _let(value, step)
    whole = F.slice(value, F.lit(1), F.greatest(F.length(bare) - (K + W - 2), F.lit(1)))  # windows that lie within the text; or one
    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(F.array_distinct(whole))


def _position(v: Column) -> Column:
    return F.lit(_PLACES - 1) - v.bitwiseAND(F.lit(_PLACES - 1))


def kept_of_start(kept: Column, size: Column) -> Column:
    """What winnowing keeps of the first size characters, from what it keeps of all.

    An entry is kept from the window on in which it comes in as the least, or, if it is greater than
    the entry before it, in which that one is gone. It stays if that window lies within the start: no
    entry behind the start's last window can, and all at or before that window's first hash do.
    """
    last = size - (K + W - 1)
    reached = F.filter(kept, lambda v: v.bitwiseAND(F.lit(_PLACES - 1)) >= F.lit(_PLACES - 1).cast("long") - (last + W - 1))

    def put(x: Column) -> Column:
        sure, seen, last = x["sure"], x["seen"], x["last"]
        before = lambda i: F.get(seen, sure + i - 1)
        opens = lambda v, i: F.when(sure + i == 0, F.lit(0)).when(v < before(i), _position(v) - (W - 1)).otherwise(_position(before(i)) + 1)
        return F.concat(F.slice(seen, F.lit(1), sure), F.filter(F.slice(seen, sure + 1, F.lit(W)), lambda v, i: opens(v, i) <= last))

    found = _let(reached, lambda r: F.struct(F.greatest(F.size(r) - W, F.lit(0)).alias("sure"), r.alias("seen"), last.alias("last")))
    return _let(found, put)


def kept_joined(a_kept: Column, a: Column, b_kept: Column, b: Column) -> Column:
    """kept(a + b) for a start a of one text and a start b of another, without white space, from what is kept of these texts.

    Only windows across the joint are worked out anew. Lengths are taken once, not for each entry.
    """
    most = K + W - 2
    none = F.array().cast("array<bigint>")

    def put(x: Column) -> Column:
        na, nb = x["na"], x["nb"]
        shift = lambda k, by: F.transform(k, lambda v: v - by)
        across = F.when((na + nb <= most) | (F.length(x["joint"]) > most), shift(kept_of(x["joint"]), na - F.least(na, F.lit(most)))).otherwise(none)
        return _let(F.struct(kept_of_start(a_kept, na).alias("a"), across.alias("c"), shift(kept_of_start(b_kept, nb), na).alias("b")), once)

    def once(x: Column) -> Column:  # neighbouring windows of two parts may keep one hash, the last of the one and the first of the other
        known = lambda v: v.eqNullSafe(F.try_element_at(x["a"], F.lit(-1))) | v.eqNullSafe(F.get(x["b"], F.lit(0)))
        return F.concat(x["a"], F.filter(x["c"], lambda v: ~known(v)), x["b"])

    joint = F.concat(F.right(a, F.lit(most)), F.left(b, F.lit(most)))
    return _let(F.struct(F.length(a).alias("na"), F.length(b).alias("nb"), joint.alias("joint")), put)


def shown(kept: Column) -> Column:
    """The entries by position, as a list: each hash * 2**31 + 2**31 - 1 - position."""
    return F.when(F.size(kept) == 0, F.lit("")).otherwise(kept.cast("string"))


def hashes(kept: Column) -> Column:
    return F.transform(kept, lambda v: F.shiftright(v, 31))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among all (1 if both are empty)."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def fingerprints(docs: DataFrame) -> DataFrame:
    """docs with kept, the winnowed hashes of text. Row by row; a null or empty text has none."""
    return docs.withColumn("kept", kept(F.col("text")))


def neighbours(docs: DataFrame) -> tuple[DataFrame, object]:
    """Rows of docs(doc_id, text) in buckets of ids, and the window in which a row's lead is its next document.

    Bounds are quantiles of the ids; an id that fills several has a bucket of its own, split by text
    hash, the order of its rows. The first row of a bucket in descending order is also a guest, at the
    end of the bucket before it (of the first bucket: of the last), so no row's next document is missing
    and no window spans more than a bucket. Null ids come last. Only bounds and sizes of
    buckets reach the driver; the table of first rows, 2 * MOST_BUCKETS at most, is joined by broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    n = rows.count()
    each = max(BUCKET_ROWS, -(-n // MOST_BUCKETS))
    buckets = max(1, -(-n // each))
    bounds = []
    if buckets > 1:
        found = list(rows.select(F.percentile_approx("place", F.lit([i / buckets for i in range(1, buckets)]), F.lit(10 * buckets)).alias("q")).first().q)
        hot = {a for a, b in zip(found, found[1:], strict=False) if a == b}
        bounds = sorted({*found, *(x + 1 for x in hot)})
    wide = max(1, math.isqrt(len(bounds)))
    chunks = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    if chunks:
        coarse, fine = F.lit([c[0] for c in chunks]), F.array(*[F.lit(c) for c in chunks])
        upto = F.size(F.filter(coarse, lambda b: b <= F.col("place")))
        within = F.size(F.filter(F.get(fine, upto - 1), lambda b: b <= F.col("place")))
        bucket = F.when(upto == 0, F.lit(0)).otherwise((upto - 1) * wide + within)
    else:
        bucket = F.lit(0)
    rows = rows.withColumn("bucket", bucket.cast("int"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("place") == F.max("place")).alias("one")).collect()
    splits = {r.bucket: -(-r.n // each) for r in sizes if r.one and r.n > each}
    hashed = F.xxhash64("text")
    if splits:
        parts = F.coalesce(F.create_map(*[F.lit(x) for pair in splits.items() for x in pair])[F.col("bucket")], F.lit(1))
        part = F.least(F.floor((hashed / F.lit(2.0**64) + 0.5) * parts).cast("int"), parts - 1)
    else:
        part = F.lit(0)
    rows = rows.withColumn("part", part)
    least = F.struct((-F.col("place").cast("decimal(20,0)")).alias("p"), F.col("place").alias("place"), hashed.alias("hash"))
    heads = rows.groupBy("bucket", "part").agg(F.min(least).alias("head"))
    row_order = Window.orderBy(F.desc("bucket"), "part")  # over that small table
    whole = row_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    up = lambda c: F.coalesce(F.lag(c).over(row_order), F.last(c).over(whole)).alias(f"up_{c}")
    small = heads.select("bucket", "part", F.col("head.place").alias("first_place"), F.col("head.hash").alias("first_hash"), up("bucket"), up("part"))
    rows = rows.join(F.broadcast(small), ["bucket", "part"])
    own = F.struct("bucket", "part", F.lit(0).alias("guest"))
    also = F.struct(F.col("up_bucket").alias("bucket"), F.col("up_part").alias("part"), F.lit(1).alias("guest"))
    places = F.when((F.col("place") == F.col("first_place")) & (hashed == F.col("first_hash")), F.array(own, also)).otherwise(F.array(own))
    rows = rows.withColumn("at", F.explode(places)).select("doc_id", "text", "place", "at.bucket", "at.part", "at.guest")
    rows = rows.repartition(min(1 << 15, max(1, len(sizes) + sum(splits.values()))), "bucket", "part")
    return rows, Window.partitionBy("bucket", "part").orderBy("guest", F.desc("place"), F.xxhash64("text"))


def compare_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row of docs(doc_id, text).

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many of the
    next document in descending order of doc_id (after the last: the first). Null texts count as
    empty: no fingerprint, and like another empty one. Rows of one id are neighbours of each other,
    by text hash. Extra columns are ignored; an empty table gives no rows. Texts are shuffled once,
    and each is hashed once: the edited text's fingerprint is put together from those of its parts.
    """
    rows, order = neighbours(docs)
    rows = rows.withColumn("bare", solid(F.col("text"))).withColumn("kept", kept_of(F.col("bare"))).drop("bare")  # only texts are shuffled
    rows = rows.withColumns({"next": F.lead("text").over(order), "next_kept": F.lead("kept").over(order)}).where("guest = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    start, end = F.left("text", F.length("text") - half), F.left(F.coalesce("next", F.lit("")), half)
    edited_kept = kept_joined(F.col("kept"), F.col("a"), F.coalesce("next_kept", F.array().cast("array<bigint>")), F.col("b"))
    rows = rows.select("*", F.sha2(F.concat(start, end).cast("binary"), 256).alias("edited_sha256"), solid(start).alias("a"), solid(end).alias("b"))
    rows = rows.withColumn("edited_kept", edited_kept)
    mine = hashes(F.col("kept"))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited_sha256",
        shown(F.col("kept")).alias("fingerprint"),
        shown(F.col("edited_kept")).alias("edited_fingerprint"),
        likeness(mine, hashes(F.col("edited_kept"))).alias("near_edited"),
        likeness(mine, hashes(F.col("next_kept"))).alias("near_next"),
    )
