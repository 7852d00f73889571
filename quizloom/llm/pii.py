"""Personal data by base patterns and a semi-Markov conditional random field.

The field labels regions: stretches of digit groups with short separators, and names joined to
hosts by an @ or its spelled forms. A region is cut into segments of at most MAX_GROUPS groups;
features look at whole segments (digits in all, check digits, separators, byte ranges, the word
before), and a segment dynamic program picks boundaries and types at once. It is trained on
regions of a bounded sample of documents, labelled by the base patterns, with copies in which
the prefix, the separators or the @ are written in other ways.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, map_arrow
from quizloom.llm.spans import Span, digest, joined, luhn

BASE = ["email", "ip", "card", "phone"]
#: Kinds of the spans that the field adds.
ADDED = [f"crf_{k}" for k in BASE]
KINDS = BASE + ADDED
#: Groups of a segment, passes, step and decay of the training.
MAX_GROUPS, PASSES, STEP, DECAY = 8, 150, 0.1, 1e-4
#: Bounds of the training sample: documents, contexts taken from them, code points of one, regions without an entity, groups of a region.
SAMPLE_DOCS, SAMPLE_CONTEXTS, SAMPLE_CHARS, SAMPLE_EMPTY, SAMPLE_GROUPS = 4000, 80_000, 2000, 2000, 40
#: Digits of a segment that may be an entity (the sign of the first group counts as one).
MIN_DIGITS, MAX_DIGITS = 4, 20

_LOCAL, _DOMAIN = re.compile(r"[A-Za-z0-9._%+-]"), re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS, _AFTER = re.compile(r"[0-9+(][0-9 ().+/-]{6,}"), re.compile(r"[A-Za-z0-9.-]+")
_NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
# A match ends where its digits end, so only the start of a run of digits can start one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_REGION = re.compile(r"\+?\(?[0-9]++(?:[\x20().\-/]{1,3}[0-9]++)*+")
_GROUP = re.compile(r"[0-9]+")
_MAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64}(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}")
_SPELLED = re.compile(r"[\[(](?:at|AT)[\])]")
_BEFORE = re.compile(r"([A-Za-z]+)[\x20:=#.]*$")


def _emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end(), "email"))
            done = m.end()
        else:
            done = max(done, at + 1) if start == at else done
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[Span]:
    out = _emails(text)
    out += [(*m.span(), "ip") for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        d = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((*m.span(), "card"))
    if "+" in text:
        out += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def regions(text: str) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, groups) of what the field looks at; groups are spans whose unions are the segments."""
    out = []
    for m in _REGION.finditer(text):
        if m.end() - m.start() >= 7:
            groups = [g.span() for g in _GROUP.finditer(text, *m.span())]
            if sum(b - a for a, b in groups) >= 7:
                groups[0] = (m.start(), groups[0][1])
                out.append((*m.span(), groups))
    if "@" in text or _SPELLED.search(text):
        out += [(*m.span(), [m.span()]) for m in _MAIL.finditer(text)]
    return out


def features(text: str, groups: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Of the segment of groups i to j - 1, whole-span features."""
    a, b = groups[i][0], groups[j - 1][1]
    s = text[a:b]
    digits = "".join(c for c in s if "0" <= c <= "9")
    letters = any(c.isalpha() for c in s)
    out = ["bias", f"groups{min(j - i, 6)}", f"letters{letters}"]
    if letters:
        out.append("at" if "@" in s else "spelled" if _SPELLED.search(s) else "none")
    else:
        out += [f"n{min(len(digits), 20)}", f"luhn{12 <= len(digits) <= 19 and luhn(digits)}", f"plus{s[0] == '+'}", f"paren{'(' in s}", f"dot{'.' in s}", f"dash{'-' in s}", f"slash{'/' in s}"]
        parts = s.split(".")
        out.append(f"quad{len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)}")
        out.append("shape" + "_".join(str(min(y - x, 7)) for x, y in groups[i:j]) if j - i <= 5 else "shapelong")
    if word := _BEFORE.search(text[max(0, a - 24) : a]):
        out.append("w_" + word[1].lower()[-8:])
    out.append(f"glued{a > 0 and text[a - 1].isalnum() or b < len(text) and text[b].isalnum()}")
    return out


def _segments(text: str, groups: list) -> list[tuple[int, int, bool, list[str]]]:
    """All segments (i, j), whether each may be an entity, and its features; one group alone may also be nothing (O)."""
    out = []
    spelled = len(groups) == 1 and any(c.isalpha() for c in text[groups[0][0] : groups[0][1]])
    for i in range(len(groups)):
        for j in range(i + 1, min(len(groups), i + MAX_GROUPS) + 1):
            n = sum(b - a for a, b in groups[i:j])
            if j > i + 1 and n > MAX_DIGITS:
                break
            entity = spelled or MIN_DIGITS <= n <= MAX_DIGITS
            if entity or j == i + 1:
                out.append((i, j, entity, features(text, groups, i, j)))
    return out


def _lattice(text: str, groups: list, weights: dict) -> list[tuple[int, int, str, float]]:
    """Segments with each type they may have, and their scores."""
    out = []
    for i, j, entity, feats in _segments(text, groups):
        for k in ("O",) * (j == i + 1) + tuple(BASE) * entity:
            out.append((i, j, k, sum(weights.get((k, f), 0.0) for f in feats)))
    return out


def decode(text: str, region: tuple, weights: dict) -> list[Span]:
    """The best segmentation of a region; its segments that are not O."""
    groups = region[2]
    best: list[tuple[float, tuple | None]] = [(0.0, None)] + [(-math.inf, None)] * len(groups)
    into = defaultdict(list)
    for e in _lattice(text, groups, weights):
        into[e[1]].append(e)
    for j in range(1, len(groups) + 1):
        best[j] = max(((best[e[0]][0] + e[3], e) for e in into[j]), key=lambda x: x[0])
    out, j = [], len(groups)
    while j:
        i, _, kind, _ = best[j][1]
        if kind != "O":
            out.append((groups[i][0], groups[j - 1][1], kind))
        j = i
    return out


def _examples(text: str) -> list[tuple[str, list, list[tuple[int, int, str]]]]:
    """Regions with the segments that the base patterns give, where these fall on group bounds."""
    gold, out = base_spans(text), []
    for start, end, groups in regions(text):
        segs, bad = [], False
        for a, b, k in gold:
            if a < end and start < b:
                i = next((n for n, g in enumerate(groups) if g[0] == a), None)
                j = next((n + 1 for n, g in enumerate(groups) if g[1] == b), None)
                if i is None or j is None or j - i > MAX_GROUPS or any(i < y and x < j for x, y, _ in segs):
                    bad = True
                    break
                segs.append((i, j, k))
        if not bad:
            lead = text[max(0, start - 24) : start]
            out.append((lead + text[start:end] + text[end : end + 1], [(x - start + len(lead), y - start + len(lead)) for x, y in groups], segs))
    return out


def _rewritten(text: str, groups: list, segs: list, rng: random.Random) -> str | None:
    """The whole-region entity written another way, or None."""
    if len(segs) != 1 or segs[0][:2] != (0, len(groups)):
        return None
    a, b = groups[0][0], groups[-1][1]
    s, kind = text[a:b], segs[0][2]
    if kind == "email":
        s = s.replace("@", " [at] ").replace(".", " [dot] ") if rng.random() < 0.5 else s.replace("@", "(at)")
    elif kind == "card":
        d = "".join(c for c in s if c.isdigit())
        s = rng.choice([".", "/"]).join(d[i : i + 4] for i in range(0, len(d), 4))
    elif kind == "phone":
        s = s.lstrip("+").partition(" ")[2] or s
    else:
        return None
    return text[:a] + s + text[b:]


def _negatives(texts: list[str], rng: random.Random) -> list[str]:
    """Number groups that are no personal data: dates and times, byte quads out of range, digits that fail their check."""
    out = []
    for t in texts:
        for a, b, k in base_spans(t):
            s = t[a:b]
            if k == "card":
                out.append(s[:-1] + str((int(s[-1]) + rng.randint(1, 9)) % 10))
            elif k == "ip":
                out.append(".".join([*s.split(".")[:3], str(rng.randint(256, 999))]))
            else:
                y, m, d = rng.randint(1950, 2040), rng.randint(1, 12), rng.randint(1, 28)
                out.append(rng.choice([f"{y}-{m:02}-{d:02}", f"{y}-{m:02}-{d:02} {d:02}", f"{d:02}/{m:02}/{y}", f"{d}.{m}.{y}", f"{y} - {y + 3}", f"{y}-{m:02}-{d:02} {d:02} {y}"]))
    return out


def train(texts: list[str], seed: int = 1) -> dict[tuple[str, str], float]:
    """Weights of the field, learnt from the texts' base spans, rewritten copies and negatives.

    At most SAMPLE_EMPTY regions without an entity, and regions of at most SAMPLE_GROUPS groups, are
    learnt from; any region is decoded. The same texts and seed give the same weights.
    """
    rng, data = random.Random(seed), []
    for t in [*texts, *_negatives(texts, rng)]:
        data += _examples(t)
    more = []
    for text, groups, segs in data:
        if new := _rewritten(text, groups, segs, rng):
            lead = groups[0][0]
            for start, _, g in regions(new):
                if start == lead and len(g) <= MAX_GROUPS:
                    more.append((new, g, [(0, len(g), segs[0][2])]))
    empty = [d for d in data if not d[2]]
    rng.shuffle(empty)
    data = [d for d in data if d[2]] + empty[:SAMPLE_EMPTY] + more
    return _fit([d for d in data if len(d[1]) <= SAMPLE_GROUPS])


def _log_sums(values: np.ndarray, node: np.ndarray, out: np.ndarray) -> None:
    """out[n] becomes the log sum of the values of node n, for all nodes given."""
    order = np.argsort(node, kind="stable")
    node, values = node[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])[: len(node)])
    if len(first):
        out[node[first]] = np.logaddexp.reduceat(values, first)


def _fit(data: list) -> dict[tuple[str, str], float]:
    """Weights that maximise the conditional likelihood of the segmentations, by full gradients with adaptive steps.

    Features of all segments are worked out once; forward and backward sums of all regions go position by position.
    """
    kinds, names = ["O", *BASE], {}
    start, end, allowed, gold, sizes, flat, base, region = [], [], [], [], [], [], [], []
    at = 0
    for n, (text, groups, segs) in enumerate(data):
        inside = {(i, j): k for i, j, k in segs}
        covered = {x for i, j, _ in segs for x in range(i, j)}
        for i, j, entity, feats in _segments(text, groups):
            right = inside.get((i, j), "O" if j == i + 1 and i not in covered else None)
            start.append(at + i)
            end.append(at + j)
            base.append((i, j))
            region.append(n)
            allowed.append([j == i + 1] + [entity] * len(BASE))
            gold.append([right == k for k in kinds])
            sizes.append(len(feats))
            flat += [names.setdefault(f, len(names)) for f in feats]
        at += len(groups) + 1
    if not start:
        return {}
    start, end, base, flat, sizes = map(np.array, (start, end, base, flat, sizes))
    allowed, gold = np.array(allowed), np.array(gold, np.float64)
    edge = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    lengths = np.array([len(g) for _, g, _ in data])
    first = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    goal = (first + lengths)[np.array(region)]
    by_end = [np.flatnonzero(base[:, 1] == j) for j in range(1, base[:, 1].max() + 1)]
    by_start = [np.flatnonzero(base[:, 0] == i) for i in range(base[:, 0].max(), -1, -1)]
    w = np.zeros((len(names), len(kinds)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, PASSES + 1):
        score = np.where(allowed, np.add.reduceat(w[flat], edge, axis=0), -math.inf)
        whole = np.logaddexp.reduce(score, axis=1)
        fwd, bwd = np.full(at, -math.inf), np.full(at, -math.inf)
        fwd[first], bwd[first + lengths] = 0.0, 0.0
        for some in by_end:
            _log_sums(fwd[start[some]] + whole[some], end[some], fwd)
        for some in by_start:
            _log_sums(bwd[end[some]] + whole[some], start[some], bwd)
        share = np.exp(np.minimum(0.0, (fwd[start] + bwd[end] - fwd[goal])[:, None] + score))
        slope = np.repeat(gold - share, sizes, axis=0)
        grad = np.stack([np.bincount(flat, slope[:, k], len(names)) for k in range(len(kinds))], axis=1) / len(data) - DECAY * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w += STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return {(k, f): float(w[i, n]) for f, i in names.items() for n, k in enumerate(kinds) if w[i, n]}


class _Reach:
    """Spans by start, and how far those up to each start reach: what a place lies in or meets is told by one search."""

    def __init__(self, spans: list[Span]):
        ordered = sorted(spans)
        self.starts = [s[0] for s in ordered]
        self.ends = list(accumulate((s[1] for s in ordered), max))

    def holds(self, a: int, b: int) -> bool:
        """Whether one span has all of a to b."""
        n = bisect_right(self.starts, a)
        return n > 0 and self.ends[n - 1] >= b

    def meets(self, a: int, b: int) -> bool:
        """Whether some span shares a place with a to b."""
        n = bisect_left(self.starts, b)
        return n > 0 and self.ends[n - 1] > a


def find(text: str, weights: dict) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans; the field adds those that overlap no base span."""
    base = base_spans(text)
    every, reach = list(base), _Reach(base)
    for r in regions(text):
        if reach.holds(r[0], r[1]):
            continue
        for a, b, k in decode(text, r, weights):
            if not reach.meets(a, b):
                every.append((a, b, f"crf_{k}"))
    return base, every


def contexts(text: str) -> list[str]:
    """What surrounds long runs of digits and @ signs, from 24 places before to 2 behind, without overlaps; read once.

    A context begins 24 places before the first place that digits or an address can begin at, and goes on with
    the last such place among its first 25.
    """
    mails = []  # of each address: where it may begin, its sign, its end
    sign = text.find("@")
    while sign >= 0:
        if after := _AFTER.match(text, sign + 1):
            start = sign
            while start > 0 and _LOCAL.match(text, start - 1):
                start -= 1
            if start < sign:
                mails.append((start, sign, after.end()))
        sign = text.find("@", sign + 1)
    signs = [m[1] for m in mails]

    def end(c: int) -> int:
        if m := _DIGITS.match(text, c):
            return m.end()
        i = bisect_right(signs, c)
        return mails[i][2] if i < len(mails) and mails[i][0] <= c else -1

    out, at, digits = [], 0, _DIGITS.search(text)
    while True:
        if digits and digits.start() < at:
            digits = _DIGITS.search(text, at)
        i = bisect_right(signs, at)
        places = ([max(at, mails[i][0])] if i < len(mails) else []) + ([digits.start()] if digits else [])
        if not places:
            return out
        first = max(at, min(places) - 24)
        last = next(e for c in range(min(first + 24, len(text) - 1), first - 1, -1) if (e := end(c)) >= 0)
        at = min(len(text), last + 2)
        out.append(text[first:at])


def sample_texts(docs: DataFrame) -> list[str]:
    """At most SAMPLE_CONTEXTS contexts of digits and @ signs, of at most SAMPLE_CHARS code points, from at most SAMPLE_DOCS documents, those of least id hash."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)

    def run(batches):
        for part, texts in blocks(batches):
            rows = [(i, c) for i, t in zip(part.column(0).to_pylist(), texts, strict=True) for c in contexts(t.decode("utf-8", "replace")) if len(c) <= SAMPLE_CHARS]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([c for _, c in rows], pa.string())], names=["doc_id", "t"])

    picked = docs.join(F.broadcast(ids), "doc_id", "left_semi").select(F.col("doc_id").cast("long"), "text")
    return [r.t for r in map_arrow(picked, run, "doc_id long, t string").orderBy("doc_id", "t").limit(SAMPLE_CONTEXTS).collect()]


def find_pii(docs: DataFrame, weights: dict | None = None, redact: bool = False) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row of docs(doc_id, text).

    weights: of train(); None trains on a bounded sample of docs. redact=True returns the rows of
    docs instead, each span replaced by its type in brackets and n_chars counted anew.
    A null or empty text has no spans (digest of the empty string) and stays as it is; repeated rows
    give equal results; other columns are ignored or kept; an empty table gives no rows.
    """
    if weights is None:
        weights = train(sample_texts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        for part, texts in blocks(batches):
            rows = []
            for t in texts:
                base, every = find(t.decode("utf-8", "replace"), shared.value)
                rows.append((*(sum(s[2] == k for s in base) for k in BASE), digest(joined(base, KINDS)), joined(every, KINDS)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4]), pa.array(cols[5])], names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    def mask(batches):
        for part, texts in blocks(batches):
            at = part.schema.get_field_index("text")
            new = [None if old is None else redacted(t.decode("utf-8", "replace"), shared.value) for old, t in zip(part.column(at).is_valid().to_pylist(), texts, strict=True) for old in [old or None]]
            cols = dict(zip(part.schema.names, part.columns, strict=True))
            cols["text"] = pa.array(new, pa.string())
            if "n_chars" in cols:
                cols["n_chars"] = pa.array([o if n is None else len(n) for n, o in zip(new, cols["n_chars"].to_pylist(), strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    if redact:
        return map_arrow(docs.withColumn("n_chars", F.col("n_chars").cast("long")) if "n_chars" in docs.columns else docs, mask, ", ".join(f"`{f.name}` {'long' if f.name == 'n_chars' else f.dataType.simpleString()}" for f in docs.schema))
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(text: str, weights: dict) -> str:
    """The text with every span replaced; where spans overlap, their union once, under the first's type."""
    _, every = find(text, weights)
    out, done = [], 0
    for a, b, k in sorted(every):
        if a >= done:
            out += [text[done:a], f"[{k.removeprefix('crf_').upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]
