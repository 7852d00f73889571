"""Vector codes: integer product quantisation by Lloyd rounds over partition-local heaps.

Vectors lie in blocks of a written table. A block keeps each part's entry, and for each entry a
heap of its parts, keyed by slack: the distance to the nearest other entry less that to its own,
plus what the entry and its fastest rival had moved in sum when the part was pushed. While that
sum stays below the key, no other entry can have come as near, so the part keeps its entry
unread. A round pops what the sum has passed, compares it exactly with all entries of its
position, pushes it again, and tells only by how much sums and counts change.

Slack is rounded down and movement up, so rounding costs a comparison at times but no
assignment. Distances are sums of whole numbers below 2**52, exact in floating point; a block or
codebook with greater ones is compared by Python's integers, all parts each round.
A round's table is written to the shared folder, and the one before is deleted.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import map_arrow
from quizloom.session import cut, drop

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Rows of a block, and components of it, at most.
BLOCK_ROWS, BLOCK_CELLS = 1 << 14, 1 << 20
#: Most of a squared distance that floating point adds up exactly; greatest long.
EXACT, MOST = 1 << 52, (1 << 63) - 1
#: Digits of sums that may pass 64 bits.
LIMB = 40
#: A label with at least this part of the rows meets its sum by broadcast; there are no more such labels than this.
HOT = 1000

Codebooks = list[list[list[int]]]


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector has as many components as the first usable one (by vec_id), a multiple of PARTS, all finite."""
    good = F.col(vector).isNotNull() & (F.size(vector) >= PARTS) & (F.size(vector) % PARTS == 0)
    finite = F.forall(F.col(vector).cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(good & finite)


def whole(rows: list) -> np.ndarray:
    """floor(SCALE * x) of vectors of one length: int64, or Python integers where they don't fit."""
    x = np.array(rows, np.float64)
    with np.errstate(over="ignore"):
        y = np.floor(x * SCALE)
    if x.size == 0 or np.abs(y).max() < 1 << 52:
        return y.astype(np.int64)
    return np.array([[math.floor(v * SCALE) if abs(v) < 1 << 40 else int(v) * SCALE for v in r] for r in x.tolist()], object).reshape(x.shape)


class Round:
    """Codebooks of one round, and what their entries have moved since the first."""

    def __init__(self, books: Codebooks, moved: np.ndarray):
        self.books, self.moved = books, moved
        self.arrays = [np.array(b, object) for b in books]
        self.greatest = max((abs(v) for b in books for e in b for v in e), default=0)
        self.float = [a.astype(np.float64) for a in self.arrays] if self.exact(0) else None

    def exact(self, greatest: int) -> bool:
        """Whether squared distances to components of that size are exact in floating point."""
        return len(self.books[0][0]) * (self.greatest + greatest) ** 2 < EXACT

    def nearest(self, x: np.ndarray, part: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry, squared distance, and slack rounded down, of each row of x."""
        n, book = len(x), self.arrays[part]
        if x.dtype == object or not self.exact(int(np.abs(x).max(initial=0))):
            at, best = np.zeros(n, np.int64), None
            for k in range(len(book)):
                d = ((x.astype(object) - book[k]) ** 2).sum(1)
                if best is None:
                    best = d
                else:
                    less = (d < best).astype(bool)
                    at[less], best = k, np.where(less, d, best)
            return at, best, np.full(n, -np.inf)
        f, c = x.astype(np.float64), self.float[part]
        at, best, slack = np.empty(n, np.int64), np.empty(n), np.empty(n)
        for a in range(0, n, 4096):
            y = f[a : a + 4096]
            # all partial sums are whole and below EXACT, so nothing is rounded
            d = (y * y).sum(1)[:, None] - 2.0 * (y @ c.T) + (c * c).sum(1)
            rows, i = np.arange(len(y)), d.argmin(1)
            own = d[rows, i]
            d[rows, i] = np.inf
            other = d.min(1)
            at[a : a + 4096], best[a : a + 4096] = i, own
            low, high = np.sqrt(other), np.sqrt(own)
            slack[a : a + 4096] = np.where(np.isinf(low), np.inf, low - high - (low + high) * 1e-9)
        return at, best.astype(np.int64), slack


def _store(x: np.ndarray) -> tuple[bytes, str]:
    """Components in the narrowest kind that holds them."""
    if x.dtype == object:
        return ",".join(map(str, x.reshape(-1).tolist())).encode(), "text"
    top = int(np.abs(x).max(initial=0))
    kind = "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "i8"
    return x.astype(kind).tobytes(), kind


def _load(x: bytes, kind: str, dim: int) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in x.split(b",")], object).reshape(-1, dim)
    return np.frombuffer(x, kind).astype(np.int64).reshape(-1, dim)


def _changes(part: int, x: np.ndarray, old: np.ndarray, new: np.ndarray, entries: int) -> list[dict]:
    """What counts (component -1) and sums of a part position's entries change by, in digits of LIMB bits."""
    out = []
    dim = x.shape[1]
    for rows, at, sign in ((new, new, 1), (old, old, -1)):
        there = rows >= 0
        if not there.any():
            continue
        at, y = at[there], x[there]
        n = np.bincount(at, minlength=entries)
        out += [{"i": part * ENTRIES + k, "j": -1, "v": sign * int(n[k])} for k in np.flatnonzero(n).tolist()]
        for j in range(dim):
            if y.dtype == object or int(np.abs(y[:, j]).max()) * len(y) >= EXACT:
                sums: dict[int, int] = defaultdict(int)
                for k, v in zip(at.tolist(), y[:, j].tolist()):
                    sums[k] += int(v)
            else:
                s = np.bincount(at, y[:, j].astype(np.float64), entries)
                sums = {k: int(s[k]) for k in np.flatnonzero(s).tolist()}
            for k, v in sums.items():
                v, at_limb = sign * v, j
                while abs(v) >> LIMB:
                    out.append({"i": part * ENTRIES + k, "j": at_limb, "v": v & ((1 << LIMB) - 1)})
                    v, at_limb = v >> LIMB, at_limb + dim
                out.append({"i": part * ENTRIES + k, "j": at_limb, "v": v})
    return out


def _assign(block: dict, now: Round) -> dict:
    """A block after one round: only parts popped from the heaps are compared and pushed again."""
    x = _load(block["x"], block["kind"], block["dim"])
    n, dim = len(x), block["dim"] // PARTS
    entry = np.frombuffer(block["entry"], np.int16).reshape(PARTS, n).astype(np.int64) if block["entry"] else np.full((PARTS, n), -1)
    order = np.frombuffer(block["heap"], np.int32).reshape(PARTS, n) if block["heap"] else None
    keys = np.frombuffer(block["slack"], np.float64).reshape(PARTS, n) if block["slack"] else None
    change, heaps_out, keys_out = [], np.empty((PARTS, n), np.int32), np.empty((PARTS, n))
    entry = entry.copy()
    for p in range(PARTS):
        part, k = x[:, p * dim : (p + 1) * dim], len(now.books[p])
        if order is None:
            heaps, popped = [[] for _ in range(k)], np.arange(n)
        else:
            ends = np.cumsum(np.bincount(entry[p], minlength=k)).tolist()
            pairs = list(zip(keys[p].tolist(), order[p].tolist()))  # heaps of all entries, one after another
            heaps, popped = [pairs[a:b] for a, b in zip([0, *ends], ends)], []
            for heap, moved in zip(heaps, now.moved[p].tolist()):
                while heap and heap[0][0] <= moved * (1 + 1e-12):
                    popped.append(heapq.heappop(heap)[1])
            popped = np.array(sorted(popped), np.int64)
        if len(popped):
            at, _, slack = now.nearest(part[popped], p)
            old = entry[p, popped]
            differs = at != old
            change += _changes(p, part[popped[differs]], old[differs], at[differs], k)
            entry[p, popped] = at
            key = slack + now.moved[p][at]
            for row, e, s in zip(popped.tolist(), at.tolist(), key.tolist()):
                heapq.heappush(heaps[e], (s, row))
        flat = [pair for heap in heaps for pair in heap]
        keys_out[p], heaps_out[p] = [s for s, _ in flat], [r for _, r in flat]
    return block | {"entry": entry.astype(np.int16).tobytes(), "heap": heaps_out.tobytes(), "slack": keys_out.tobytes(), "change": change}


def _next(now: Round, sums: dict, counts: dict) -> Round:
    """The next round's codebooks: floors of means, unused entries as they are; movement is rounded up."""
    books, moved = [], now.moved.copy()
    for p, book in enumerate(now.books):
        new = [[sums[p, k, j] // counts[p, k] for j in range(len(e))] if counts[p, k] else e for k, e in enumerate(book)]
        step = [float(math.isqrt(sum((a - b) ** 2 for a, b in zip(e, f))) + 1) if e != f else 0.0 for e, f in zip(book, new)]
        step = [math.sqrt(d) * (1 + 1e-9) if (d := sum((a - b) ** 2 for a, b in zip(e, f))) < EXACT else s for e, f, s in zip(book, new, step)]
        top = sorted(step, reverse=True)[:2]
        for k, s in enumerate(step):
            rival = (top[1] if len(top) > 1 else 0.0) if s == top[0] else top[0]
            moved[p, k] = (moved[p, k] + s + rival) * (1 + 1e-12)
        books.append(new)
    return Round(books, moved)


def vector_codes(df: DataFrame, rounds: int = ROUNDS, entries: int = ENTRIES) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every usable row of df(vec_id, embedding, label).

    A vector that is null, empty, or holds a null or non-finite component goes, as does one whose length is no
    multiple of PARTS or not that of the usable row with the least vec_id. A codebook begins with the
    least vec_ids (entries of them, ENTRIES at most; null last, ties by components), or with all if there are fewer. Repeated rows
    give equal rows; rows of one null vec_id or label are rows like others, and null labels are one label.
    Errors past 64 bits are the greatest long. Other columns are not read; an empty table gives no rows.
    """
    spark = df.sparkSession
    vectors = usable(df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), "label"))
    least = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding")
    first = least.limit(entries).collect()  # ENTRIES rows at most
    field, labels = T.StructField, df.schema["label"].dataType
    result = T.StructType([field("vec_id", T.LongType()), field("code", T.StringType()), field("error", T.LongType()), field("label", labels)])
    if not first:
        none = spark.createDataFrame([], result)
        return none.select("vec_id", "code", "error", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    length = len(first[0].embedding)
    vectors = vectors.where(F.size("embedding") == length)
    if any(len(r.embedding) != length for r in first):
        first = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").select("embedding").limit(entries).collect()
    start, dim = whole([r.embedding for r in first]), length // PARTS
    books = [[[int(v) for v in row[p * dim : (p + 1) * dim]] for row in start.tolist()] for p in range(PARTS)]
    now = Round(books, np.zeros((PARTS, len(first))))
    change = T.ArrayType(T.StructType([field("i", T.IntegerType()), field("j", T.IntegerType()), field("v", T.LongType())]))
    kept = {"vec_id": T.ArrayType(T.LongType()), "label": T.ArrayType(labels), "dim": T.IntegerType(), "x": T.BinaryType(), "kind": T.StringType(), "entry": T.BinaryType(), "heap": T.BinaryType(), "slack": T.BinaryType(), "change": change}
    schema = T.StructType([field(k, t) for k, t in kept.items()])

    def emit(block: dict, ids: pa.Array, tags: pa.Array):
        one = lambda a: pa.ListArray.from_arrays(np.array([0, len(a)], np.int32), a)
        kinds = {"dim": pa.int32(), "x": pa.binary(), "kind": pa.string(), "entry": pa.binary(), "heap": pa.binary(), "slack": pa.binary(), "change": pa.list_(pa.struct([("i", pa.int32()), ("j", pa.int32()), ("v", pa.int64())]))}
        return pa.RecordBatch.from_arrays([one(ids), one(tags), *[pa.array([block[k]], t) for k, t in kinds.items()]], ["vec_id", "label", *kinds])

    def build(batches):
        rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // length))
        held, size = [], 0

        def block():
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            x = whole(table.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, length))
            data, kind = _store(x)
            return emit(_assign({"dim": length, "x": data, "kind": kind, "entry": None, "heap": None, "slack": None}, now), table.column(0), table.column(2))

        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                held.append(batch.slice(a, rows))
                size += held[-1].num_rows
                if size >= rows:
                    yield block()
                    held.clear()
                    size = 0
        if size:
            yield block()

    def stored(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                block = {k: batch.column(i)[r].as_py() for i, k in enumerate(batch.schema.names) if k in ("dim", "x", "kind", "entry", "heap", "slack")}
                yield block, batch.column(0)[r].values, batch.column(1)[r].values

    def step(now):
        return lambda batches: (emit(_assign(block, now), ids, tags) for block, ids, tags in stored(batches))

    def finish(now):
        def run(batches):
            for block, ids, tags in stored(batches):
                block = _assign(block, now)
                x = _load(block["x"], block["kind"], length)
                entry = np.frombuffer(block["entry"], np.int16).reshape(PARTS, len(ids)).astype(np.int64)
                near = np.concatenate([now.arrays[p][entry[p]] for p in range(PARTS)], 1)
                if x.dtype != object and now.exact(int(np.abs(x).max())):
                    error = ((x - near.astype(np.int64)) ** 2).sum(1)
                else:
                    error = [min(MOST, int(v)) for v in ((x.astype(object) - near) ** 2).sum(1)]
                code = [bytes(row).hex() for row in entry.astype(np.uint8).T]
                yield pa.RecordBatch.from_arrays([ids, pa.array(code, pa.string()), pa.array(error, pa.int64()), tags], ["vec_id", "code", "error", "label"])

        return run

    sums, counts = defaultdict(int), defaultdict(int)
    state = cut(map_arrow(vectors, build, schema), "codes")
    for left in range(rounds, 0, -1):
        told = state.select(F.explode("change").alias("c")).groupBy("c.i", "c.j").agg(F.sum("c.v").alias("v"))
        for r in told.collect():  # a count and a sum or more for each component of PARTS * ENTRIES entries
            p, k = divmod(r.i, ENTRIES)
            if r.j < 0:
                counts[p, k] += r.v
            else:
                limb, j = divmod(r.j, dim)
                sums[p, k, j] += r.v << (LIMB * limb)
        now = _next(now, sums, counts)
        if left > 1:
            past, state = state, cut(map_arrow(state, step(now), schema), "codes")
            drop(past)
    coded = cut(map_arrow(state, finish(now), result), "coded")
    drop(state)
    text = ",".join(str(v) for b in now.books for e in b for v in e)
    return _label_errors(coded).withColumn("codebooks_sha256", F.lit(hashlib.sha256(text.encode()).hexdigest()))


def _label_errors(coded: DataFrame) -> DataFrame:
    """coded with the sum of errors over equal labels. Labels of a HOT-th of the rows or more, HOT at most, meet their sum by broadcast."""
    per = cut(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum"), F.count("*").alias("rows")), "labels")
    per = per.select(F.col("label").alias("l"), F.least("sum", F.lit(MOST)).cast("long").alias("label_error"), "rows")
    total = per.agg(F.sum("rows")).first()[0] or 0
    often = (F.col("rows") * HOT >= total) & (F.coalesce(F.octet_length(F.col("l").cast("string")), F.lit(0)) <= 1024)
    same, hot = F.expr("label <=> l"), F.broadcast(per.where(often))
    others = coded.join(hot, same, "left_anti").join(per.where(~often), same)
    return coded.join(hot, same).unionByName(others).select("vec_id", "code", "error", "label_error")
