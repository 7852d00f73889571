"""Phrase collocation mining: frequent words as numbers, n-grams as fixed-width keys, sorted by ranges and counted by run length.

Words are counted first. A phrase that occurs MIN_COUNT times has words that occur as often, so
only those get numbers, and pieces break at all others. Each place of a piece then gives one key:
its number and the four that follow, zeros past the end of the piece. In the order of the keys
all places of one phrase, of whatever length, lie side by side, so one sort counts phrases of two
to five words at once, by the run lengths of their leading numbers.

Keys are counted within a block of texts before they are shuffled: what a block repeats is sent
once. Ranges are cut at keys of a bounded sample, which decides how even they are and nothing
else; a phrase that goes on across a cut is counted on each side and added up.

Numbers come from a broadcast dictionary of at most HEAD words and HEAD_BYTES bytes. Beyond that
bound the most frequent words are broadcast, and any other word's number is its hash (checked to
be of one word alone), in wider keys. Pieces don't break there, which costs rows but changes no
count, as a phrase with a rare word can't be frequent.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, map_arrow
from quizloom.session import cut

MIN_COUNT, LONGEST, TOP, UND = 100, 5, 2000, "und"
#: A candidate goes where a longer one that holds it has at least this share of its count, in hundredths.
HELD = 100
HEAD, HEAD_BYTES = 200_000, 16 << 20
#: Numbers of a key sorted at once before the shuffle, words counted before they are sent, keys that a range is meant to hold, and the most ranges.
BLOCK, FLUSH, RANGE_ROWS, MOST_RANGES = 1 << 20, 400_000, 1 << 20, 20_000
#: Bytes of text after which counts are sent in any case.
READ = 64 << 20
#: Keys that the sample is meant to hold for each range and in all; a sampled document has at most so many bytes and gives one in STEP of its keys.
EACH, SAMPLE, SHORT, STEP = 200, 200_000, 1 << 20, 61
#: Bytes of a text split into words at once.
CHUNK = 1 << 20
#: Parts that each language's candidates are ranked in before its last ranking.
SALTS = 64
_BITS = np.uint64(21)
_MASK = np.uint64((1 << 21) - 1)
_BREAKS = b".,;:!?\n\x0b\x0c\r"
#: A-Z to a-z, tabs to blanks, breaks to 255, which no UTF-8 has.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + _BREAKS, b"abcdefghijklmnopqrstuvwxyz " + b"\xff" * len(_BREAKS))


def _langs(part: pa.RecordBatch) -> list[str]:
    return [UND if x is None else str(x) for x in part.column(part.schema.get_field_index("lang")).to_pylist()]


def _chunks(text: bytes, breaks: bytes):
    """Lists of the words of a text, breaks as the value given, a bounded part at a time, cut at blanks."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + CHUNK) if len(folded) - at > CHUNK else -1
        end = len(folded) if end < 0 else end
        yield folded[at:end].replace(b"\xff", breaks).split()
        at = end


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, c of every word of docs(text, lang)."""

    def count(batches):
        found: dict[str, Counter] = {}
        read = 0

        def rows():
            pairs = [(lang, w, n) for lang, per in found.items() for w, n in per.items()]
            found.clear()
            langs, words, counts = zip(*pairs) if pairs else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], ["lang", "word", "c"])

        for part, texts in blocks(batches):
            for lang, t in zip(_langs(part), texts):
                per = found.setdefault(lang, Counter())
                for words in _chunks(t, b" "):
                    per.update(words)
                read += len(t)
            if read > READ or sum(map(len, found.values())) > FLUSH:
                yield rows()
                read = 0
        yield rows()

    sent = map_arrow(docs.select("text", F.col("lang").cast("string").alias("lang")), count, "lang string, word string, c long")
    return sent.groupBy("lang", "word").agg(F.sum("c").alias("c"))


class Numbers:
    """Numbers of words: ranks in the dictionary from 1, 0 for none; hash: other words get a hash with bit 62 set."""

    def __init__(self, rows: list[tuple[str, str]], hashed: bool):
        self.hashed, self.by = hashed, {}
        for i, (lang, word) in enumerate(rows):
            self.by.setdefault(lang, {})[word.encode()] = i + 1

    @property
    def width(self) -> int:
        return LONGEST if self.hashed else 2

    def of(self, lang: str, words: list[bytes]) -> np.ndarray:
        known = self.by.get(lang, {})
        got = np.fromiter(map(known.get, words, repeat(0)), np.int64, len(words))
        if self.hashed:
            front = lang.encode() + b"\0"
            for i in np.flatnonzero(got == 0).tolist():
                if words[i] != b"\xff":
                    got[i] = xxhash.xxh64_intdigest(front + words[i], 42) & ((1 << 62) - 1) | (1 << 62)
        return got


def tail_number() -> F.Column:
    """The number of a word beyond the dictionary, as Numbers has it."""
    h = F.xxhash64(F.concat_ws("\0", "lang", "word"))
    return h.bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))


def pack(ids: np.ndarray, wide: bool) -> np.ndarray:
    """Keys (rows of unsigned words, the first leading) of numbers (rows of LONGEST)."""
    u = ids.astype(np.uint64)
    if wide:
        return u
    return np.stack([(u[:, 0] << _BITS | u[:, 1]) << _BITS | u[:, 2], u[:, 3] << _BITS | u[:, 4]], 1)


def unpack(keys: np.ndarray) -> np.ndarray:
    if keys.shape[1] == LONGEST:
        return keys
    a, b = keys[:, 0], keys[:, 1]
    return np.stack([a >> _BITS >> _BITS, a >> _BITS & _MASK, a & _MASK, b >> _BITS, b & _MASK], 1)


def window_keys(ids: np.ndarray, own: int, wide: bool) -> np.ndarray:
    """The key of each of the first own places that a phrase of two words or more begins at; ids: numbers with 0 for breaks."""
    full = np.append(ids, np.zeros(LONGEST, np.int64))
    at = np.flatnonzero((full[:own] != 0) & (full[1 : own + 1] != 0))
    out = np.empty((len(at), LONGEST), np.int64)
    out[:, 0], out[:, 1] = full[at], full[at + 1]
    for j in range(2, LONGEST):
        out[:, j] = np.where(out[:, j - 1] != 0, full[at + j], 0)
    return pack(out, wide)


def run_lengths(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each is there."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    keys = keys[np.lexsort(keys.T[::-1])]
    starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
    return keys[starts], np.diff(np.append(starts, len(keys)))


def _binary(keys: np.ndarray) -> pa.Array:
    """Keys as binary values whose byte order is their order."""
    size = 8 * keys.shape[1]
    data = pa.py_buffer(np.ascontiguousarray(keys, dtype=">u8").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(np.arange(0, (len(keys) + 1) * size, size, dtype=np.int32)), data])


def _keys(column: pa.Array, width: int) -> np.ndarray:
    """The inverse of _binary."""
    size = 8 * width
    at = column.offset
    first = np.frombuffer(column.buffers()[1], np.int32, 1, at * 4)[0] if len(column) else 0
    data = np.frombuffer(column.buffers()[2], ">u8", len(column) * width, int(first)) if len(column) else np.zeros(0)
    assert len(data) * 8 == len(column) * size
    return data.astype(np.uint64).reshape(-1, width)


def _numbered(batches, numbers: Numbers):
    """(ids, own) of whole texts, a break after each: of about BLOCK numbers the first own places are meant; what follows them is only read on."""
    held, size = [], 0
    for part, texts in blocks(batches):
        for lang, t in zip(_langs(part), texts):
            for words in _chunks(t, b" \xff "):
                held.append(numbers.of(lang, words))
                size += len(words)
            held.append(np.zeros(1, np.int64))
            if size >= BLOCK:
                yield from _sliced(np.concatenate(held))
                held, size = [], 0
    if held:
        yield from _sliced(np.concatenate(held))


def _sliced(ids: np.ndarray):
    for a in range(0, len(ids), BLOCK):
        yield ids[a : a + BLOCK + LONGEST], min(BLOCK, len(ids) - a)


def phrase_counts(docs: DataFrame, numbers: Numbers, tokens: int) -> DataFrame:
    """ids (LONGEST numbers, zeros last) and a, the count, of every phrase of two words or more with MIN_COUNT."""
    spark = docs.sparkSession
    texts = docs.select("text", F.col("lang").cast("string").alias("lang"))
    told, width, wide = spark.sparkContext.broadcast(numbers), numbers.width, numbers.hashed

    def sample(batches):
        for ids, own in _numbered(batches, told.value):
            yield pa.RecordBatch.from_arrays([_binary(window_keys(ids, own, wide)[::STEP])], ["key"])

    parts = min(MOST_RANGES, max(-(-tokens // RANGE_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    share = min(SAMPLE, EACH * parts) * STEP / max(1, tokens)
    some = texts.where(F.octet_length("text") <= SHORT)
    drawn = sorted(bytes(r.key) for r in map_arrow(some.sample(share, 7) if share < 1 else some, sample, "key binary").collect())
    kind = f"S{8 * width}"
    cuts = spark.sparkContext.broadcast(np.array(sorted({drawn[len(drawn) * i // parts] for i in range(1, parts)}) if drawn else [], kind))

    def keyed(batches):
        for ids, own in _numbered(batches, told.value):
            keys, n = run_lengths(window_keys(ids, own, wide))
            if len(keys):
                # both are in order: a key's range is the number of cuts at or before it
                before = np.searchsorted(np.ascontiguousarray(keys, dtype=">u8").view(kind).reshape(-1), cuts.value)
                part = np.cumsum(np.bincount(before, minlength=len(keys) + 1))[: len(keys)].astype(np.int32)
                for a in range(0, len(keys), 1 << 16):
                    b = a + (1 << 16)
                    yield pa.RecordBatch.from_arrays([_binary(keys[a:b]), pa.array(n[a:b], pa.int64()), pa.array(part[a:b])], ["key", "n", "part"])

    sent = map_arrow(texts, keyed, "key binary, n long, part int")
    ranged = sent.repartitionById(parts, F.col("part")).select("key", "n").sortWithinPartitions("key")

    def count(batches):
        """Runs of each length; the first and the last of a range are given whatever their count, as they may go on in another."""
        open_: dict[int, tuple] = {}
        first = dict.fromkeys(range(2, LONGEST + 1), True)

        def rows(ids, sums):
            flat = np.ascontiguousarray(ids, dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.arange(0, flat.size + 1, LONGEST, dtype=np.int32), pa.array(flat.reshape(-1))), pa.array(sums, pa.int64())], ["ids", "a"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids = unpack(_keys(batch.column(0), width))
            n = batch.column(1).to_numpy()
            changed = np.zeros(len(ids), bool)
            changed[0] = True
            differs = ids[1:] != ids[:-1]
            changed[1:] = differs[:, 0]
            for k in range(2, LONGEST + 1):
                changed[1:] |= differs[:, k - 1]
                starts = np.flatnonzero(changed)
                sums, heads = np.add.reduceat(n, starts), np.zeros((len(starts), LONGEST), np.uint64)
                heads[:, :k] = ids[starts, :k]
                give = sums >= MIN_COUNT
                if k in open_ and (open_[k][0] == heads[0]).all():
                    sums[0] += open_[k][1]
                    give[0] = sums[0] >= MIN_COUNT or first[k]
                else:
                    if k in open_:
                        if open_[k][0][k - 1] and (open_[k][1] >= MIN_COUNT or first[k]):
                            yield rows(open_[k][0][None], open_[k][1:])
                        first[k] = False
                    if first[k]:
                        give[0] = True
                open_[k] = (heads[-1], sums[-1])
                if len(starts) > 1:
                    first[k] = False
                give[-1] = False
                give &= heads[:, k - 1] != 0
                if give.any():
                    yield rows(heads[give], sums[give])
        for k, (head, total) in open_.items():
            if head[k - 1]:
                yield rows(head[None], [total])

    found = map_arrow(ranged, count, "ids array<long>, a long")
    return found.groupBy("ids").agg(F.sum("a").alias("a")).where(F.col("a") >= MIN_COUNT)


def collocations(docs: DataFrame) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's TOP phrases of two to five words.

    A null text is empty; a null lang is the language `und` and shares it with texts so marked. Repeated
    rows count each; texts of any length are counted whole. Ties go by count, then by the phrase's
    UTF-8 bytes. Other columns are not read, whatever their names; an empty table gives no rows.
    """
    words = cut(word_counts(docs.select("text", "lang")), "words")
    totals = cut(words.groupBy("lang").agg(F.sum("c").alias("n")), "totals")
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    often = words.where(F.col("c") >= MIN_COUNT)
    size = F.octet_length("word") + F.octet_length("lang")
    head = often.where(size <= HEAD_BYTES // 64).orderBy(F.desc("c"), "lang", "word").limit(HEAD).select("lang", "word", "c").collect()
    held, keep = 0, 0
    while keep < len(head) and held <= HEAD_BYTES:
        held += len(head[keep].word.encode()) + len(head[keep].lang.encode())
        keep += 1
    head = head[: keep - (held > HEAD_BYTES)]
    hashed = len(head) < often.count()
    numbers = Numbers([(r.lang, r.word) for r in head], hashed)
    spark = docs.sparkSession
    table = spark.createDataFrame([(i + 1, r.lang, r.word, r.c) for i, r in enumerate(head)], "id long, lang string, word string, c long")
    if hashed:
        rest = words.join(F.broadcast(table.select("lang", "word")), ["lang", "word"], "left_anti").withColumn("id", tail_number())
        if clash := rest.groupBy("id").count().where("count > 1").limit(1).collect():
            raise ValueError(f"two words have the number {clash[0].id}")
        rest = rest.where(F.col("c") >= MIN_COUNT).select("id", "lang", "word", "c")
    counted = cut(phrase_counts(docs, numbers, tokens), "phrases")

    one = counted.select("ids", "a", F.posexplode(F.filter("ids", lambda x: x != 0)).alias("pos", "id"))
    named = one.join(F.broadcast(table), "id")  # at most HEAD words and HEAD_BYTES bytes
    if hashed:
        named = named.unionByName(one.where(F.col("id") >= 1 << 62).join(rest, "id"))
    item = F.array_sort(F.collect_list(F.struct("pos", "word", "c")))
    spelled = named.groupBy("ids").agg(F.first("a").alias("a"), F.first("lang").alias("lang"), item.alias("w"))
    spelled = spelled.select("lang", "a", F.transform("w", lambda x: x.word).alias("words"), F.transform("w", lambda x: x.c).alias("c"))
    known = cut(spelled.withColumn("phrase", F.array_join("words", " ")), "known")

    size = F.size("words")
    shorter = known.where(size > 2).select("lang", "a", F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("part"))
    shorter = shorter.groupBy("lang", F.array_join("part", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    free = known.join(shorter, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < HELD * F.col("a")))

    # A single word's count is at hand; its key is one that only this row has, so that no frequent word gathers rows.
    cuts = free.select("lang", "phrase", "words", "c", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    own = F.concat(F.lit(" "), F.col("phrase"))
    part = lambda at, n: F.when(n == 1, own).otherwise(F.array_join(F.slice("words", at, n), " "))
    cuts = cuts.withColumns({"lp": part(F.lit(1), F.col("k")), "rp": part(F.col("k") + 1, F.size("words") - F.col("k"))})
    left, right = (known.select("lang", F.col("phrase").alias(p), F.col("a").alias(n)) for p, n in (("lp", "lc"), ("rp", "rc")))
    cuts = cuts.join(left, ["lang", "lp"], "left").join(right, ["lang", "rp"], "left")
    cuts = cuts.select("lang", "phrase", "a", "k", F.coalesce("lc", F.element_at("c", 1)).alias("l"), F.coalesce("rc", F.element_at("c", -1)).alias("r"))
    # Languages can be as many as the rows name, so their totals are joined, not broadcast.
    big = lambda c: c.cast("decimal(19,0)")
    scored = cuts.join(totals, "lang").withColumn("score", F.call_function("div", big(1000 * F.col("a")) * big(F.col("n")), big(F.col("l")) * big(F.col("r"))).cast("long"))
    worst = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("s"), F.first("a").alias("a"), F.first("n").alias("n"))
    worst = worst.select("lang", "phrase", "a", "s.l", "s.r", "n", "s.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = worst.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    some = salted.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= TOP)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= TOP)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
