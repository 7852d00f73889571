"""Toxicity by a support vector machine over a subsequence string kernel with Nystroem landmarks.

The kernel of two strings sums, over all subsequences of three letters within a span of SPAN
letters, the product of their weights DECAY ** (span - 3): gaps cost weight, so an insult with
letters put in or left out keeps most of its likeness. A string's explicit features are those
subsequences, coded over the letters that landmarks use. Landmarks are words and word starts
that mark the toxic texts of the training sample. A word's likeness to a landmark is the kernel
over the landmark's own norm, at most 1, to the power SHARP. If the word spells the landmark
with letters put in, or lacks one inner letter, the kernel is instead taken of that alignment:
the mean weight of its neighbouring pairs. Words so spelled that the sample's other texts use
as well are left to the kernel. A document sums the likenesses of its words and is mapped by the inverse root of the landmarks'
kernel matrix, which is its Nystroem map; the mapped vector's length is then damped, so that one
long text doesn't stand for many. A linear machine with squared hinge loss and a logistic link
gives the score. Every text is scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import blocks, crc_mod, map_arrow, sole
from quizloom.session import cut

HELD_OUT, FOLDS, CUT = 2, 4, 0.3
#: Training sample: at most this many rows of each label, those of least id hash.
SAMPLE = 3000
LANDMARKS, CANDIDATES = 48, 4000
SPAN, DECAY, SHARP, LEAST = 6, 0.7, 6, 0.15
#: A landmark's weight of evidence, its toxic texts times the log of their share over the sample's share, is this at least.
EVIDENCE, STARTS = 12.0, (3, 4, 5, 6, 7, 8)
#: And so many times its share among the other texts.
ODDS = 20.0
MAX_KNOWN, MAX_WORD = 120_000, 48
#: An alignment has so many letters between neighbouring letters of a landmark of ALIGNED letters or more.
ALIGNED, BETWEEN = 4, 2

#: Characters that stand for letters.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
_PUNCTUATION = re.compile(r"[^\w@$!]+|_+")
_OFFSETS = [(a, b) for a, b in combinations(range(1, SPAN), 2)]


def words(text: str) -> Counter:
    """Lower-case words as they stand, and each run of three or more single letters as one word."""
    tokens = text.lower().split()
    out = Counter(tokens)
    if sum(n for w, n in out.items() if len(w) == 1) >= 3:
        at = 0
        for single, run in groupby(tokens, lambda w: len(w) == 1):
            n = len(list(run))
            if single and n >= 3:
                out["".join(tokens[at : at + n])] += 1
            at += n
    return out


def parts(word: str) -> list[str]:
    """The word with punctuation taken out and look-alikes put back; if it is very long, by pieces that overlap by half."""
    if not word.isalpha():
        word = _PUNCTUATION.sub("", word).strip("@$!")
        if not word.isdigit():
            word = word.translate(LOOKALIKES)
    half = MAX_WORD // 2
    return [word[at : at + MAX_WORD] for at in range(0, max(min(len(word), 1), len(word) - half), half)]


class Kernel:
    """Likeness of words to landmarks, and the map by the landmarks' own kernel matrix."""

    def __init__(self, landmarks: list[str], plain: frozenset[str] = frozenset()):
        self.landmarks, self.plain = landmarks, plain
        self.spelled: dict[str, list[tuple[int, int, re.Pattern]]] = {}
        self.lacking: dict[str, list[int]] = {}
        for m, x in enumerate(landmarks):
            if len(x) >= ALIGNED:
                self.spelled.setdefault(x[0], []).append((m, len(x), re.compile(f".{{0,{BETWEEN}}}?".join(map(re.escape, x)))))
            if len(x) > ALIGNED:
                for short in {x[:i] + x[i + 1 :] for i in range(1, len(x) - 1)}:
                    self.lacking.setdefault(short, []).append(m)
        letters = sorted({c for x in landmarks for c in "^" + x})
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        self.size = len(letters) + 1
        table = np.zeros((self.size**3, len(landmarks)), np.float32)
        for m, x in enumerate(landmarks):
            for code, weight in self._features(x).items():
                table[code, m] += weight
        norms = (table**2).sum(0)
        self.used = np.flatnonzero(table.any(1))
        self.table = np.vstack([np.zeros((1, len(landmarks)), np.float32), table[self.used] / np.maximum(norms, 1e-9)])
        self.most = self.table.max(1)
        self.row = np.zeros(self.size**3, np.int32)  # a code with a foreign letter has row 0
        self.row[self.used] = np.arange(1, len(self.used) + 1)
        gram = np.array(self.kernel(landmarks), np.float64)
        gram = (gram + gram.T) / 2
        value, vector = np.linalg.eigh(gram)
        keep = value > 1e-3
        self.root = vector[:, keep] / np.sqrt(value[keep])
        self.known: dict[str, np.ndarray | None] = {}
        self.older: dict[str, np.ndarray | None] = {}

    def _features(self, word: str) -> dict[int, float]:
        c = [self.code.get(x, 0) for x in "^" + word]
        out: dict[int, float] = {}
        for i in range(len(c)):
            for a, b in _OFFSETS:
                if i + b < len(c) and c[i] and c[i + a] and c[i + b]:
                    k = (c[i] * self.size + c[i + a]) * self.size + c[i + b]
                    out[k] = out.get(k, 0.0) + DECAY ** (b - 2)
        return out

    def aligned(self, word: str) -> list[tuple[int, float]]:
        """Landmarks that the word spells with letters put in or one left out, and the mean weight of a neighbouring pair.

        Letters after the landmark count as put in, if others are.
        """
        out = [(m, DECAY) for m in self.lacking.get(word, ())]
        for m, n, pattern in self.spelled.get(word[:1], ()):
            if (found := pattern.match(word)) and found.end() > n:
                out.append((m, DECAY ** ((len(word) - n) / (n - 1))))
        return out

    def likeness(self, ws: list[str]) -> np.ndarray:
        """(words, landmarks)."""
        out = self.kernel(ws)
        for i, w in enumerate(ws):
            if (found := self.aligned(w)) and w not in self.plain:
                for m, weight in found:
                    if weight >= LEAST:
                        out[i, m] = max(out[i, m], weight)
        return out

    def kernel(self, ws: list[str]) -> np.ndarray:
        """(words, landmarks); words of one length are worked out together."""
        out = np.zeros((len(ws), len(self.landmarks)), np.float32)
        by_length: dict[int, list[int]] = {}
        for n, w in enumerate(ws):
            by_length.setdefault(len(w), []).append(n)
        for length, rows in by_length.items():
            for at in range(0, len(rows), 8192):
                mine = rows[at : at + 8192]
                text = np.array([[self.code.get(c, 0) for c in "^" + ws[n]] for n in mine], np.int32)
                rows_of = []
                bound = np.zeros(len(mine), np.float32)
                for i in range(length + 1):
                    for a, b in _OFFSETS:
                        if i + b <= length:
                            row = self.row[(text[:, i] * self.size + text[:, i + a]) * self.size + text[:, i + b]]
                            weight = np.float32(DECAY ** (b - 2))
                            bound += self.most[row] * weight
                            rows_of.append((row, weight))
                hit = np.flatnonzero(bound >= LEAST ** (1 / SHARP) - 1e-4)  # others are under it for every landmark
                total = np.zeros((len(hit), len(self.landmarks)), np.float32)
                for row, weight in rows_of:
                    r = row[hit]
                    some = np.flatnonzero(r)
                    total[some] += self.table[r[some]] * weight
                out[np.array(mine)[hit]] = np.minimum(total, 1) ** SHARP
        out[out < LEAST] = 0
        return out

    def documents(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text the Nystroem map of the summed likenesses of its words, its length damped to log(1 + length)."""
        if len(self.known) > MAX_KNOWN:
            self.older, self.known = self.known, {}
        counts, known, new = [words(t) for t in texts], self.known, {}
        for mine in counts:
            for w in mine:
                if w not in known and w not in new:
                    if w in self.older:
                        known[w] = self.older[w]
                    else:
                        new[w] = parts(w)
        listed = sorted({p for ps in new.values() for p in ps})
        place = {p: i for i, p in enumerate(listed)}
        like = self.likeness(listed)
        some = like.any(1)
        for w, ps in new.items():
            hit = [place[p] for p in ps if some[place[p]]]
            known[w] = like[hit].sum(0) if hit else None
        out = []
        for mine in counts:
            total = np.zeros(len(self.landmarks))
            for w, n in mine.items():
                if (v := known[w]) is not None:
                    total += n * v
            mapped = total @ self.root
            length = float(np.linalg.norm(mapped))
            out.append(mapped * (math.log1p(length) / length) if length else mapped)
        return out


def _learnable():
    return F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), FOLDS) != HELD_OUT)


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic and text of the training sample: of each label at most SAMPLE ids outside the held-out fold."""
    seen = labels.where(_learnable()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = None
    for label in (1, 0):
        part = seen.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
        ids = part if ids is None else ids.unionByName(part)
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    one = found.groupBy("doc_id").agg(F.min_by(F.struct("text", "toxic"), F.xxhash64("text")).alias("r"))  # of repeated ids one row
    return cut(one.select("doc_id", "r.toxic", "r.text"), "labelled")


def _candidates(sample: DataFrame) -> list[tuple[str, int, int]]:
    """(string, toxic texts, other texts) of the CANDIDATES words and word starts that tell most."""

    def run(batches):
        for part, texts in blocks(batches):
            toxic = part.column(part.schema.get_field_index("toxic")).to_pylist()
            met: Counter = Counter()
            for t, y in zip(texts, toxic, strict=True):
                mine = set()
                for raw in words(t.decode("utf-8", "replace")):
                    for w in parts(raw):
                        mine.add(w)
                        mine.update(w[:k] for k in STARTS if k < len(w))
                met.update((w, y) for w in mine if len(w) >= 3)
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in met], pa.string()), pa.array([y for _, y in met], pa.int32()), pa.array(list(met.values()), pa.int64())], names=["w", "y", "n"])

    found = map_arrow(sample.select("text", F.col("toxic").cast("int").alias("toxic")), run, "w string, y int, n long")
    found = found.groupBy("w").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1.0)
    worth = F.col("a") * F.log((F.col("a") + 0.01) / (F.col("a") + F.col("b") + 0.01) / share)
    odds = (F.col("a") / max(1, sizes.get(1, 0))) / ((F.col("b") + 0.5) / (sizes.get(0, 0) + 1.0))
    found = found.where("a > 0").withColumn("worth", worth).where((F.col("worth") >= EVIDENCE) & (odds >= ODDS))
    return [(r.w, r.a, r.b) for r in found.orderBy(F.desc("worth"), F.desc(F.length("w")), "w").limit(CANDIDATES).collect()]


def choose(candidates: list[tuple[str, int, int]]) -> list[str]:
    """At most LANDMARKS strings by worth, none of which another, chosen before, is much like."""
    out: list[str] = []
    seen: list[Counter] = []
    for w, _, _ in candidates:
        mine = Counter(tuple(("^" + w)[k] for k in (i, i + a, i + b)) for i in range(len(w)) for a, b in _OFFSETS[:3] if i + b <= len(w))
        if any(sum((mine & s).values()) > 0.6 * min(sum(mine.values()), sum(s.values())) for s in seen):
            continue
        out.append(w)
        seen.append(mine)
        if len(out) == LANDMARKS:
            break
    return out


def _plain(sample: DataFrame, landmarks: list[str], sizes: dict[int, int]) -> frozenset[str]:
    """Of the words that spell a landmark by an alignment, the CANDIDATES most used of those that don't tell."""
    shared = sample.sparkSession.sparkContext.broadcast(landmarks)

    def run(batches):
        k = Kernel(shared.value)
        for part, texts in blocks(batches):
            toxic = part.column(part.schema.get_field_index("toxic")).to_pylist()
            met: Counter = Counter()
            for t, y in zip(texts, toxic, strict=True):
                mine = {w for raw in words(t.decode("utf-8", "replace")) for w in parts(raw)}
                met.update((w, y) for w in mine if k.aligned(w))
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in met], pa.string()), pa.array([y for _, y in met], pa.int32()), pa.array(list(met.values()), pa.int64())], names=["w", "y", "n"])

    found = map_arrow(sample.select("text", F.col("toxic").cast("int").alias("toxic")), run, "w string, y int, n long")
    found = found.groupBy("w").agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    odds = (F.col("a") / max(1, sizes.get(1, 0))) / ((F.col("b") + 0.5) / (sizes.get(0, 0) + 1.0))
    return frozenset(r.w for r in found.where((F.col("b") > 0) & (odds < ODDS)).orderBy(F.desc("b"), "w").limit(CANDIDATES).collect())


def fit_linear(x: np.ndarray, y: np.ndarray, share: float = 0.5, c: float = 100.0, steps: int = 1500) -> tuple[np.ndarray, float, float, float]:
    """Weights and bias of a machine with squared hinge loss, toxic rows weighing share in all, and slope and offset of its logistic link."""
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, share / max(1, (y > 0).sum()), (1 - share) / max(1, (y <= 0).sum()))
    w, b = np.zeros(x.shape[1]), 0.0
    step = 1.0 / (1.0 / c + 2 * float((weight * ((x**2).sum(1) + 1)).sum()) + 1e-9)
    vw, vb, pw, pb = w.copy(), b, w.copy(), b
    for k in range(steps):  # accelerated gradient descent
        slack = np.maximum(0, 1 - sign * (x @ vw + vb))
        gw = vw / c - 2 * x.T @ (weight * sign * slack)
        gb = -2 * float((weight * sign * slack).sum())
        w, b = vw - step * gw, vb - step * gb
        m = k / (k + 3)
        vw, vb = w + m * (w - pw), b + m * (b - pb)
        pw, pb = w, b
    f = x @ w + b
    slope, offset = 2.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * f + offset, -30, 30)))
        g = weight * (p - (y > 0))
        slope -= 2.0 * (float((g * f).sum()) + 1e-3 * (slope - 2))
        offset -= 2.0 * float(g.sum())
    return w, b, max(slope, 0.5), offset


def train(docs: DataFrame, labels: DataFrame) -> tuple[list[str], frozenset[str], np.ndarray, float, float, float]:
    """Landmarks, plain words, weights, bias, slope and offset. Without toxic rows, or any rows, nothing is toxic.

    Of a repeated id one row is learnt from, that whose text hashes least, with the greater label; null
    ids, null labels and labels other than 0 and 1 are left out; a null text counts as empty.
    """
    sample = _sample(docs, labels)
    landmarks = choose(_candidates(sample))
    if not landmarks:
        return ["none"], frozenset(), np.zeros(1), -3.0, 1.0, 0.0
    plain = _plain(sample, landmarks, {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()})
    kernel = Kernel(landmarks)
    shared = docs.sparkSession.sparkContext.broadcast((landmarks, plain))

    def run(batches):
        k = Kernel(*shared.value)
        for part, texts in blocks(batches):
            xs = [x.tolist() for x in k.documents([t.decode("utf-8", "replace") for t in texts])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(xs, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = map_arrow(sample.select(F.col("toxic").cast("int").alias("toxic"), "text"), run, "toxic int, x array<double>").collect()  # 2 * SAMPLE rows at most
    rows.sort(key=lambda r: (r.toxic, r.x))
    x, y = np.array([r.x for r in rows]).reshape(len(rows), kernel.root.shape[1]), np.array([r.toxic for r in rows])
    # The sample has as many rows of either label as it can; the link goes by the labels' own shares.
    sizes = {r.toxic: r.n for r in labels.where(_learnable()).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    return landmarks, plain, *fit_linear(x, y, sizes.get(1, 0) / max(1, sum(sizes.values())))


_kernels: dict[tuple, Kernel] = {}


def _kernel_table() -> dict:
    return _kernels


def score_toxicity(docs: DataFrame, model: tuple, keep: bool = False) -> DataFrame:
    """doc_id, score and predicted of every row of docs(doc_id, text); keep=True: the rows of docs not predicted toxic.

    Each whole text is scored by its own words; a null or empty text has the score of no words.
    lang, source, labels and doc_id are no inputs. Repeated rows give equal results; extra
    columns are ignored, or kept as they are; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scores(texts):
        landmarks, plain, w, b, slope, offset = shared.value
        key = (tuple(landmarks), plain)
        sole(_kernels)
        if key not in _kernels:
            _kernels.clear()
            _kernels[key] = Kernel(landmarks, plain)
        kernel = _kernels[key]
        found = kernel.documents([t.decode("utf-8", "replace") for t in texts])
        return [1 / (1 + math.exp(-min(30.0, max(-30.0, slope * (float(x @ w) + b) + offset)))) for x in found]

    def run(batches):
        for part, texts in blocks(batches):
            s = scores(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array([int(x >= CUT) for x in s], pa.int32())], names=["doc_id", "score", "predicted"])

    def clean(batches):
        for part, texts in blocks(batches):
            yield part.filter(pa.array([x < CUT for x in scores(texts)]))

    if keep:
        return map_arrow(docs, clean, docs.schema, _kernel_table)
    return map_arrow(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, score double, predicted int", _kernel_table)


def held_out():
    """Whether a row's label may not be learnt from."""
    return crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT
