"""SimHash near-duplicates, linked by balls of half the radius.

Two fingerprints at distance 3 or less meet half-way: one of them is at distance 1 or 0 from
some meeting point and the other at distance 2 or less. Each fingerprint emits its ball of
radius 1 (65 variants). Distance 2 meets there. A pair at distance 3 has fingerprints of
opposite parity, and two of the three bits lie in the same half of the word; so it is enough
that those of even parity also emit the variants with two bits flipped in one half (992).
In a bucket every member is linked to one centre, the least member at distance 1 or 0 from
the meeting point: all members are within 3 of it, so the links are real, they reach all that
meet there, and their number is linear in the size of the bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import ASCII_LOWER, blocks, fresh, map_arrow
from quizloom.llm.components import components
from quizloom.session import cut

WORDS, SEED, RADIUS = 3, 42, 3
_BLOCK = 1 << 14
#: Fingerprints of a half-word whose variants are written out in one place.
HOT = 4000


def fingerprint(text: bytes) -> int:
    """64 bits; a bit is set if it is set in over half the hashes of the word shingles. No word: 0."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = hashes[at : at + _BLOCK]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches):
    for part, texts in blocks(batches):
        fps = np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([*part.drop_columns(["text"]).columns, pa.array(fps)], names=[*(n for n in part.schema.names if n != "text"), "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (long) of every row; a null text counts as empty."""
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), _fingerprints, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(nodes: DataFrame) -> DataFrame:
    """Links (u, v) of distinct fingerprints (column fp): each real, and enough to connect all within 3 bits.

    A variant is dealt by the half-word that its two flipped bits leave as it is, so all variants
    of a fingerprint that go to one place go as one row and are written out there. Of a half-word
    that very many fingerprints share, variants are written out first and dealt one by one: the rows
    are as many, but spread over all places. Such half-words are the only thing that is broadcast: each
    stands for over HOT fingerprints. Without the hint Spark may broadcast the other side, 66 rows a fingerprint.
    """
    sides = []
    for side, (kept, flipped) in enumerate(((range(32, 64), range(32)), (range(32), range(32, 64)))):
        ones = [_signed(1 << i) for i in flipped]
        twos = [_signed(1 << i | 1 << j) for i in flipped for j in flipped if i < j]
        sides.append((side, _signed(sum(1 << i for i in kept)), [_signed(1 << i) for i in kept], ones, twos))
    counts = nodes.select("fp", F.explode(F.array(*[F.struct(F.lit(s).alias("side"), F.col("fp").bitwiseAND(F.lit(k)).alias("key")) for s, k, *_ in sides])).alias("k")).groupBy("k.side", "k.key").agg(F.count("*").alias("n"))
    hot = counts.where(F.col("n") > HOT).select(F.col("side").alias("hs"), F.col("key").alias("hk"))
    moves = F.array(*[F.struct(F.lit(s).alias("side"), F.col("fp").bitwiseXOR(F.lit(m)).bitwiseAND(F.lit(k)).alias("key"), F.lit(m).alias("move")) for s, k, keep, *_ in sides for m in (0, *keep)])
    sent = nodes.select("fp", F.explode(moves).alias("m")).select("fp", "m.side", "m.key", "m.move")
    sent = sent.join(F.broadcast(hot), (F.col("side") == F.col("hs")) & (F.col("key") == F.col("hk")), "left").withColumn("is_hot", F.col("hk").isNotNull())
    masks = F.array(F.col("move"))
    for s, _, _, ones, twos in sides:
        own = F.when(F.bit_count("fp") % 2 == 0, F.lit([0, *ones, *twos])).otherwise(F.lit([0, *ones]))
        masks = F.when((F.col("move") == 0) & (F.col("side") == s), own).otherwise(masks)
    near = F.when(F.bit_count("mask") <= 1, F.col("fp"))
    real = F.bit_count(F.col("fp").bitwiseXOR(F.col("centre"))) <= RADIUS

    def met(rows: DataFrame) -> DataFrame:
        ball = rows.select("fp", "side", "key", F.explode(masks).alias("mask")).withColumn("meet", F.col("fp").bitwiseXOR(F.col("mask")))
        seen = ball.withColumn("centre", F.min(near).over(Window.partitionBy("side", "key", "meet")))
        return seen.where(F.col("centre").isNotNull() & (F.col("fp") != F.col("centre")) & real).select(F.col("fp").alias("u"), F.col("centre").alias("v"))

    few = met(sent.where("NOT is_hot").repartition("side", "key"))
    return few.union(met(sent.where("is_hot"))).distinct()


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp, fingerprint (16 hex digits) and component_id of every row of docs(doc_id, text).

    component_id is the smallest doc_id reachable over links of 3 or fewer differing bits, the
    row's own included. Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows stay and share their component; a null doc_id never names a component unless
    no other id is there. Equal fingerprints are one node, so groups of copies cost one node.
    Extra columns are ignored; an empty table gives an empty result. Joins are sort-merge joins: their
    sides are as many as fingerprints, too many for the driver to broadcast.
    """
    fps = cut(fingerprints(docs), "fps")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = rooted.join(least.hint("merge"), "root").select("fp", "component_id")
    return fps.join(named.hint("merge"), "fp").select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component: that of its smallest doc_id, of equal ids the one whose text hashes least.

    A component is one of fingerprints, so rows of one doc_id with unlike texts are apart. A null id
    comes after all others. Null and empty texts are one component. Of rows equal in id and text that
    whose columns as JSON hash least stays. Columns are those of docs, of any type and name; an empty
    table gives no rows. Texts are shuffled once, after all copies but one of each are gone.
    """
    mark, text_hash = fresh(docs, "fp", "text_hash")
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    fps = cut(map_arrow(docs.select(F.col("doc_id").cast("long"), "text", hashed.alias("h")), _fingerprints, "doc_id long, h long, fp long"), "fps")
    nodes = fps.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("rep"))
    roots = components(links(nodes.select("fp")))
    least = nodes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").groupBy(F.coalesce("root", "fp")).agg(F.min("rep").alias("rep"))
    stay = least.select(F.col("rep.doc_id").alias(mark), F.col("rep.h").alias(text_hash))
    named = docs.withColumn(text_hash, hashed)
    kept = named.join(stay.hint("merge"), F.col("doc_id").cast("long").eqNullSafe(stay[mark]) & (named[text_hash] == stay[text_hash]), "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = kept.groupBy("doc_id", text_hash).agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias(mark))
    return one.select(*[F.col(mark)[c].alias(c) for c in docs.columns])
