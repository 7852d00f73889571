"""Removal of repeated byte strings by a depth-limited radix sort of synchronised suffixes.

Two places share a string of DEPTH bytes exactly if their suffixes agree to that depth, so the
suffixes need to be ordered no further. Windows of DEPTH bytes are ordered through their
synchronising places: the place of the least hash of the window's K-grams (of equals the
rightmost). The choice depends on the window's bytes alone, so equal windows synchronise at the
same offset, and neighbours share a place: one record of at most 2 * DEPTH - K bytes holds about
(DEPTH - K) / 2 windows. Two passes:

1. A filter. A place whose K bytes only one text has holds no repeated window, and goes no
   further. It is made by hashes; a collision lets a place through and can lose none. Whole texts
   are settled with it: copies of a text with a smaller id go wholly.
2. The order. Records that are left are ordered by their bytes, in digits of eight, most
   significant first, and only groups of more than one record go on to the next digit: first the
   K bytes at the place, then outward the bytes behind it and those before it. Windows of one
   group and offset are equal exactly if they agree in both orders to the depth that the offset
   asks for. The equal groups are the repeated windows; the least document id of each is found.

Equality of windows is by bytes. Only copies of whole texts are told by a digest, of 128 bits.

Documents lie in buckets by a hash of their id, records in ranges by a hash of the K bytes. A
bucket sends each range one block of records, each record once however many of its documents
hold it; the range answers with one bit for each window. So no place, copy or passage makes a
large group anywhere.
"""

from __future__ import annotations

import gc
import hashlib
import time
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.session import cut, ship

DEPTH, K = 50, 28
#: Bytes of text that a bucket is meant to hold.
BUCKET_BYTES = 8 << 20
_STEPS = DEPTH - K + 1
#: Bytes of a record on either side of its K, and in all.
_SIDE, _RECORD = DEPTH - K, 2 * DEPTH - K
#: Leading bits of keys in tables of a bucket.
_TABLE = 24
#: Fixed value: an odd base for hashes modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
#: Bytes that are worked on at once: several texts, or a part of a long one; parts overlap as far as windows reach.
_PART = 1 << 18


@cache
def _constants(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of bytes, powers of the base, powers of its inverse."""
    rng = np.random.default_rng(1000)
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    size = 1
    while size < n:  # by doubling
        m = min(size, n - size)
        up[size : size + m] = up[:m] * np.uint64(pow(_BASE, size, 1 << 64))
        down[size : size + m] = down[:m] * np.uint64(pow(inverse, size, 1 << 64))
        size += m
    return values, up, down


class Hashes:
    """Hashes of all substrings of a text by sums over prefixes."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        room = 1 << max(12, int(n + 1).bit_length())
        values, self.up, down = _constants(room)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[text] * down[:n], out=self.sums[1:])

    def runs(self, size: int) -> np.ndarray:
        """Hashes of all substrings of a size; only the upper bits are well mixed."""
        return (self.sums[size:] - self.sums[:-size]) * (self.up[: len(self.sums) - size] * np.uint64(0xD6E8FEB86659FD93))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self.up[start]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))


def _spread(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All whole numbers of the spans, ends included."""
    n = last - first + 1
    return np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else np.zeros(0, np.int64)


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as differences, by planes of bytes, so that leading zeros compress."""
    gaps = np.diff(values, prepend=values.dtype.type(0))
    return gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel(), dtype=np.uint64)


class Bucket:
    """Distinct texts of a bucket with the least id of each, and the digits that their windows have."""

    def __init__(self, texts: list[bytes], ids: list[int], bits: int, ranges: int):
        self.shift, self.ranges = np.uint64(64 - bits), ranges
        least: dict[bytes, int] = {}
        for t, i in zip(texts, ids, strict=True):
            if len(t) >= DEPTH:
                least[t] = min(i, least.get(t, i))
        self.texts = sorted(least, key=least.get)
        self.ids = np.array([least[t] for t in self.texts], np.int64)
        self.number = {t: n for n, t in enumerate(self.texts)}
        self.dropped = np.zeros(len(self.texts), bool)
        self.spots = [(nums, offs, at, data, *self._spots(offs, data)) for nums, offs, at, data in self._chunks()]

    def _chunks(self):
        """(numbers of the texts, their offsets, offset within the text, bytes)."""
        some, held = [], 0
        for n, t in enumerate(self.texts):
            if some and held + len(t) > _PART:
                yield self._joined(some)
                some, held = [], 0
            if len(t) > _PART:
                for at in range(0, len(t) - DEPTH + 1, _PART):
                    yield np.array([n]), np.array([0]), at, np.frombuffer(t, np.uint8, min(_PART + DEPTH - 1, len(t) - at), at)
            else:
                some.append(n)
                held += len(t)
        if some:
            yield self._joined(some)

    def _joined(self, some: list[int]):
        sizes = [len(self.texts[n]) for n in some]
        return np.array(some), np.concatenate([[0], np.cumsum(sizes)[:-1]]), 0, np.frombuffer(b"".join(self.texts[n] for n in some), np.uint8)

    def _spots(self, offs: np.ndarray, data: np.ndarray):
        """Synchronising places of the windows that lie within one text: key, first and last window, place."""
        one = Hashes(data)
        # 32 bits of the hash above, the place counted backwards below: the least is the rightmost of equals.
        order = (one.runs(K) & np.uint64(0xFFFFFFFF00000000)) | np.arange(0xFFFFFFFF, 0xFFFFFFFF - (len(data) - K + 1), -1, dtype=np.uint64)
        size = 1
        while size < _STEPS:
            step = min(size, _STEPS - size)
            order = np.minimum(order[:-step], order[step:])
            size += step
        within = _spread(offs, np.append(offs[1:], len(data)) - DEPTH)
        place = order[within]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(within)) - 1
        at = (np.uint64(0xFFFFFFFF) - (place[first] & np.uint64(0xFFFFFFFF))).astype(np.int64)
        return one.of(at, at + K) >> self.shift << self.shift, within[first], within[last], at

    def cuts(self, keys: np.ndarray) -> np.ndarray:
        """Where each range's share of the ascending keys of 64 bits begins and ends."""
        edges = np.array([(r << 64) // self.ranges for r in range(1, self.ranges)], np.uint64)
        return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)

    def _grouped(self, keys: list[np.ndarray], owners: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys in order, and whether more than one text has them."""
        if not sum(map(len, keys)):
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        every, owner = np.concatenate(keys), np.concatenate(owners)
        if len(self.texts) < 1 << int(self.shift):  # the owner fits beside the key
            every = np.sort(every | owner.astype(np.uint64))
            owner = every & np.uint64((1 << int(self.shift)) - 1)
            every = every >> self.shift << self.shift
        else:
            order = np.lexsort((owner, every))
            every, owner = every[order], owner[order]
        new = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])[: len(every)])
        end = np.append(new[1:], len(every)) - 1
        return every[new], owner[new] != owner[end]

    def copies(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Digests of whole texts in order, in two halves, and their ids."""
        both = np.array([np.frombuffer(hashlib.blake2b(t, digest_size=16).digest(), "<u8") for t in self.texts], np.uint64).reshape(-1, 2)
        self.order = np.lexsort((both[:, 1], both[:, 0]))
        return both[self.order, 0], both[self.order, 1], self.ids[self.order]

    def drop(self, copy: np.ndarray) -> None:
        """Takes texts, in the order of copies(), out of the second pass: another bucket has them with a smaller id."""
        self.dropped[self.order] = copy

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the filter, and whether two texts here have them."""
        return self._grouped([x[4] for x in self.spots], [x[0][np.searchsorted(x[1], x[5], "right") - 1] for x in self.spots])

    def second(self, alive: np.ndarray) -> Records:
        """Records of the places in play, each once, with the least id that it has here."""
        parts, among = [], _among(alive)
        self.windows = []
        for nums, offs, begin, data, key, first, last, at in self.spots:
            part = np.searchsorted(offs, first, "right") - 1
            on = among(key) & ~self.dropped[nums[part]]
            part, first, last, at = part[on], first[on], last[on], at[on]
            low, high = at - last, at - first
            sides = np.pad(data, _SIDE)
            rows = np.lib.stride_tricks.sliding_window_view(sides, _RECORD)[at] & _within()[high, low]
            parts.append((key[on], rows, low.astype(np.uint8), high.astype(np.uint8), nums[part]))
            self.windows.append((nums[part], at - offs[part] + begin))
        empty = (np.zeros(0, np.uint64), np.zeros((0, _RECORD), np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.int64))
        key, rows, low, high, owner = (np.concatenate(x) for x in zip(empty, *([p[i] for i in range(5)] for p in parts), strict=True))
        mixed = (rows.view(np.uint64) * _constants(256)[0][: _RECORD // 8]).sum(1, dtype=np.uint64)
        order = np.lexsort((owner, mixed, key))  # owners ascend, and so do their ids
        key, rows, low, high, owner = key[order], rows[order], low[order], high[order], owner[order]
        same = (rows[1:] == rows[:-1]).all(1) & (low[1:] == low[:-1]) & (high[1:] == high[:-1]) & (key[1:] == key[:-1])
        new = np.concatenate([[True], ~same])[: len(key)]
        self.slot = np.empty(len(key), np.int64)
        self.slot[order] = np.cumsum(new) - 1
        return Records(key[new], rows[new], low[new], high[new], self.ids[owner[new]])

    def marks(self, records: Records, smaller: np.ndarray) -> dict[int, np.ndarray]:
        """Starts of the windows that a smaller id has too, by number of text; smaller: one bit a window, by offset of the place."""
        found, done = [], 0
        for owner, at in self.windows:
            slot = self.slot[done : done + len(at)]
            done += len(at)
            bits = (smaller[slot][:, None] >> np.arange(_STEPS, dtype=np.uint32)) & 1 != 0
            bits |= (records.ids[slot] < self.ids[owner])[:, None]
            offset = np.arange(_STEPS, dtype=np.uint8)
            which, offset = np.nonzero(bits & (offset >= records.low[slot][:, None]) & (offset <= records.high[slot][:, None]))
            found.append((owner[which], at[which] - offset))
        owner, start = (np.concatenate([np.zeros(0, np.int64), *x]) for x in ([f[i] for f in found] for i in range(2)))
        if not len(owner):
            return {}
        order = np.argsort(owner, kind="stable")
        owner, start = owner[order], start[order]
        edge = np.flatnonzero(np.diff(owner, prepend=-1))
        return {int(owner[x]): start[x:y] for x, y in zip(edge, np.append(edge[1:], len(owner)), strict=True)}


class Records(NamedTuple):
    """Bytes around synchronising places, zero where no window of the place reaches.

    A window whose place stands at offset o begins o bytes before it; low and high are the least and greatest o.
    """

    key: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    ids: np.ndarray


@cache
def _within() -> np.ndarray:
    """Masks of a record's bytes that windows of offsets low to high reach, by [high, low]."""
    at, offset = np.arange(_RECORD), np.arange(_STEPS)
    before, behind = at >= _SIDE - offset[:, None], at < _RECORD - offset[:, None]
    return np.where(before[:, None] & behind[None], 0xFF, 0).astype(np.uint8)


def _words(rows: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian digits of eight bytes, one a line."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return wide.view(">u8").astype(np.uint64).T


def _refined(group: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Numbers of the groups that a further digit makes of groups, in order."""
    order = np.lexsort((digit, group))
    g, d = group[order], digit[order]
    out = np.empty(len(g), np.int64)
    out[order] = np.cumsum(np.concatenate([[False], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])[: len(g)])
    return out


def _depths(group: np.ndarray, side: np.ndarray):
    """Groups that agree in group and in a number of bytes of side: a function of that number."""
    order = np.lexsort((*_words(side)[::-1], group))
    g, rows = group[order], side[order]
    unlike = np.column_stack([rows[1:] != rows[:-1], np.ones(max(0, len(g) - 1), bool)])
    common = np.where(g[1:] == g[:-1], unlike.argmax(1), -1)  # with the record before

    def upto(depth: int) -> np.ndarray:
        out = np.empty(len(g), np.uint64)
        out[order] = np.cumsum(np.concatenate([[False], common < depth])[: len(g)])
        return out

    return upto


def windows_of_smaller_ids(rows: np.ndarray, low: np.ndarray, high: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """One bit for each window of each record: whether an equal window has a smaller id. By the order of their bytes."""
    found = np.zeros(len(rows), np.uint32)
    play, group = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    for digit in _words(rows[:, _SIDE : _SIDE + K]):
        group = _refined(group, digit[play])
        many = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        play, group = play[many], group[many]
    rows, low, high, ids = rows[play], low[play], high[play], ids[play]
    before, behind = _depths(group, rows[:, _SIDE - 1 :: -1]), _depths(group, rows[:, _SIDE + K :])
    for offset in range(_STEPS):
        some = np.flatnonzero((low <= offset) & (high >= offset))
        if len(some) < 2:
            continue
        pair = before(offset)[some] << np.uint64(32) | behind(_SIDE - offset)[some]
        order = np.argsort(pair)
        start = np.diff(pair[order], prepend=~pair[order[0]]) != 0
        least = np.minimum.reduceat(ids[some][order], np.flatnonzero(start))
        mine = some[order]
        mine = mine[least[np.cumsum(start) - 1] < ids[mine]]
        found[play[mine]] |= np.uint32(1 << offset)
    return found


def _among(some: np.ndarray):
    """A test whether keys may be among some: by their leading bits, so no key is missed and a few others pass, which the order tells apart."""
    table = np.zeros(1 << _TABLE, bool)
    table[some >> np.uint64(64 - _TABLE)] = True
    return lambda keys: table[keys >> np.uint64(64 - _TABLE)]


_BLOCK = "range int, bucket int, keys binary, more binary"
_ANSWER = "bucket int, digit int, range int, bits binary"


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers by planes of bytes, so that leading zeros compress."""
    return numbers.view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _unplaned(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T.copy().view(kind).ravel()


def _blocks(bucket: int, cuts: np.ndarray, block, start: int = 0) -> pa.Table:
    """One row for each range that gets anything: block(a, b) gives its two byte strings. The ranges are numbered from start."""
    rows = [(start + r, bucket, *block(a, b)) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    cols = zip(*rows, strict=True) if rows else ([], [], [], [])
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["range", "bucket", "keys", "more"])


def _shared(blocks: pa.Table) -> list[bytes]:
    """Whether more than one text has a key, from all buckets' blocks of a range: a bit for each key."""
    lists, flags = [unpack(k) for k in blocks["keys"].to_pylist()], []
    for k, m in zip(lists, blocks["more"].to_pylist(), strict=True):
        flags.append(np.unpackbits(np.frombuffer(m, np.uint8), count=len(k)).astype(bool))
    every = np.sort(np.concatenate(lists))
    twice = np.append(np.unique(every[1:][every[1:] == every[:-1]]), np.uint64(0xFFFFFFFFFFFFFFFF))
    return [np.packbits(f | (twice[np.searchsorted(twice, k)] == k)).tobytes() for k, f in zip(lists, flags, strict=True)]


def _least(blocks: pa.Table) -> list[bytes]:
    """Whether another bucket has a smaller id for a whole text: a bit for each text."""
    lists = [unpack(k) for k in blocks["keys"].to_pylist()]
    sizes = np.cumsum([len(k) for k in lists])[:-1]
    halves = [m[: len(m) // 2] for m in blocks["more"].to_pylist()], [m[len(m) // 2 :] for m in blocks["more"].to_pylist()]
    high = np.concatenate(lists)
    low, ids = np.concatenate([_unplaned(m, "<u8") for m in halves[0]]), np.concatenate([_unplaned(m, "<i8") for m in halves[1]])
    order = np.lexsort((low, high))
    start = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])
    smaller = np.zeros(len(order), bool)
    smaller[order] = np.minimum.reduceat(ids[order], np.flatnonzero(start))[np.cumsum(start) - 1] < ids[order]
    return [np.packbits(x).tobytes() for x in np.split(smaller, sizes)]


def _ordered(blocks: pa.Table) -> list[bytes]:
    """Whether another record has an equal window with a smaller id: a bit for each window, 32 a record."""
    rows = [np.frombuffer(k, np.uint8).reshape(-1, _RECORD) for k in blocks["keys"].to_pylist()]
    sizes = np.cumsum([len(r) for r in rows])[:-1]
    more = [np.frombuffer(m, np.uint8).reshape(10, -1) for m in blocks["more"].to_pylist()]
    ids = np.concatenate([m[2:].T.copy().view("<i8").ravel() for m in more])
    low, high = np.concatenate([m[0] for m in more]), np.concatenate([m[1] for m in more])
    found = windows_of_smaller_ids(np.concatenate(rows), low, high, ids)
    return [_planes(x) for x in np.split(found.astype("<u4"), sizes)]


def _first_answers(ranges: int):
    """Answers to both kinds of the first pass's blocks: whole texts lie in ranges of their own."""

    def run(blocks: pa.Table) -> pa.Table:
        r = blocks["range"][0].as_py()
        return _answers(blocks, 1, r, _shared(blocks)) if r < ranges else _answers(blocks, 0, r - ranges, _least(blocks))

    return run


def _second_answers(blocks: pa.Table) -> pa.Table:
    return _answers(blocks, 2, blocks["range"][0].as_py(), _ordered(blocks))


def _answers(blocks: pa.Table, digit: int, r: int, bits: list[bytes]) -> pa.Table:
    n = blocks.num_rows
    return pa.table([blocks["bucket"], pa.array([digit] * n, pa.int32()), pa.array([r] * n, pa.int32()), pa.array(bits, pa.binary())], names=["bucket", "digit", "range", "bits"])


def _chosen(answers: pa.Table, digit: int, cuts: np.ndarray) -> np.ndarray:
    """The answers of all ranges in the order of the bucket's keys: bits, or 32 of them for each record."""
    out = np.zeros(int(cuts[-1]), np.uint32 if digit == 2 else bool)
    for d, r, bits in zip(answers["digit"].to_pylist(), answers["range"].to_pylist(), answers["bits"].to_pylist(), strict=True):
        if d == digit:
            a, b = cuts[r], cuts[r + 1]
            out[a:b] = _unplaned(bits, "<u4") if digit == 2 else np.unpackbits(np.frombuffer(bits, np.uint8), count=int(b - a)).astype(bool)
    return out


def _load(docs: pa.Table, bits: int, ranges: int) -> tuple[Bucket, list[bytes]]:
    texts = docs["text"].to_pylist()
    return Bucket(texts, docs["place"].to_pylist(), bits, ranges), texts


def _result(texts: list[bytes], ids: list[int], b: Bucket, marks: dict[int, np.ndarray]) -> list[tuple]:
    rows, done = [], {}
    for t, i in zip(texts, ids, strict=True):
        n = b.number.get(t)
        if n is not None and (i > b.ids[n] or b.dropped[n]):  # a copy of a text of a smaller id
            rows.append((len(t), len(t), 1, hashlib.sha256(b"").hexdigest()))
            continue
        if t not in done:
            gone = np.zeros(len(t) + 1, np.int32)
            if n in marks:
                gone[marks[n]] += 1  # a window has one place, so its start is met once
                gone[marks[n] + DEPTH] -= 1
            off = np.cumsum(gone)[:-1] > 0
            spans = int((np.diff(off.astype(np.int8), prepend=0) == 1).sum())
            left = np.frombuffer(t, np.uint8)[~off].tobytes()
            done[t] = (len(t), int(off.sum()), spans, hashlib.sha256(left).hexdigest())
        rows.append(done[t])
    return rows


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of docs(doc_id, text).

    A byte goes if a string of DEPTH bytes covers it that also starts in a document of a smaller
    doc_id; strings are judged on the input. Null texts count as empty, null ids as larger than any
    other; rows of equal ids don't count against each other. Other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce("text", F.lit("")).cast("binary")
    size, rows = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    number = max(4, -(-size // BUCKET_BYTES))
    bits = min(64, max(32, int(size).bit_length() + 12))
    place = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    # Salted by the text, so that equal ids don't make a large bucket.
    bucket = F.pmod(F.xxhash64("doc_id", "text"), F.lit(number)).cast("int")
    base = docs.select(bucket.alias("bucket"), place.alias("place"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def bucket_of(table: pa.Table) -> int:
        return table["bucket"][0].as_py() if table.num_rows else -1

    def first(table: pa.Table) -> pa.Table:
        b, _ = _load(table, bits, number)
        keys, many = b.first()
        high, low, ids = b.copies()
        short = keys >> np.uint64(64 - bits)  # the other bits are zero
        places = _blocks(bucket_of(table), b.cuts(keys), lambda x, y: (pack(short[x:y]), np.packbits(many[x:y]).tobytes()))
        texts = _blocks(bucket_of(table), b.cuts(high), lambda x, y: (pack(high[x:y]), _planes(low[x:y]) + _planes(ids[x:y])), number)
        return pa.concat_tables([places, texts])

    def upto_second(b: Bucket, answers: pa.Table) -> Records:
        b.drop(_chosen(answers, 0, b.cuts(b.copies()[0])))
        keys, _ = b.first()
        return b.second(keys[_chosen(answers, 1, b.cuts(keys))])

    def second(table: pa.Table, answers: pa.Table) -> pa.Table:
        b, _ = _load(table, bits, number)
        x = upto_second(b, answers)
        more = np.vstack([x.low[None], x.high[None], x.ids.view(np.uint8).reshape(-1, 8).T])
        return _blocks(bucket_of(table), b.cuts(x.key), lambda i, j: (x.rows[i:j].tobytes(), more[:, i:j].tobytes()))

    def last(table: pa.Table, answers: pa.Table) -> pa.Table:
        b, texts = _load(table, bits, number)
        records = upto_second(b, answers)
        rows = _result(texts, table["place"].to_pylist(), b, b.marks(records, _chosen(answers, 2, b.cuts(records.key))))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        cols = zip(*rows, strict=True) if rows else ([], [], [], [])
        return pa.table([table["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    def beside(answers: DataFrame):
        return base.groupBy("bucket").cogroup(answers.groupBy("bucket"))

    answers = cut(base.groupBy("bucket").applyInArrow(first, _BLOCK).groupBy("range").applyInArrow(_first_answers(number), _ANSWER), "answers")
    _free(spark)
    answers = answers.union(cut(beside(answers).applyInArrow(second, _BLOCK).groupBy("range").applyInArrow(_second_answers, _ANSWER), "answers"))
    _free(spark)
    return beside(answers).applyInArrow(last, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _free(spark) -> None:
    """Lets Spark delete the shuffle files of passes whose answers are written: it does so when their frames are collected."""
    for _ in range(3):  # the driver's collector works beside us
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.7)
