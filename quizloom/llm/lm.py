"""Language-model scores: word counts as a base, and the marginal probability over a subword lattice.

The lattice model takes the pieces of an existing vocabulary and their scores: log probabilities,
or, in a vocabulary of merges, ranks, of which the start is 1 / (rank + RANKED). Scores are then fitted to the training texts by expectation maximisation
over their word counts; the end of a text is a piece of its own. A text's probability is the
sum over all ways to cut it into pieces, by a forward recursion in log space. No piece goes
past a white space, so the sum is a product over words, and each distinct word of the corpus is
worked out once.

Word counts come from all training texts. The HEAD most frequent words of at most HEAD_BYTES
(fixed bounds) are broadcast; all others meet their counts in a join, so no vocabulary is held in one place.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quizloom.llm.common import ASCII_LOWER, blocks, crc_mod, map_arrow
from quizloom.session import cut, ship

HELD_OUT = 2
FOLDS = 7
HEAD, PASSES, PRIOR = 100_000, 2, 0.5
#: Expected counts are added up as whole numbers of this part, so that sums don't depend on their order.
UNIT = 1 << 16
WIDE = 48
#: Offset of ranks; bytes of a word that the broadcast head may hold.
RANKED, HEAD_BYTES = 20.0, 64
#: Bytes of a long word whose arcs are looked up at once.
_SPAN = 1 << 16
_BASE = np.uint64(1_099_511_628_211)
_NONE = -1e30


def load_pieces(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece model in order, as bytes, a word start as a space, with their scores; then the 256 single bytes, scored least. Read on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)):
            b = sp.id_to_piece(i).replace("▁", " ").encode()
            if b" " not in b[1:] and b == b.translate(ASCII_LOWER):
                found.setdefault(b, sp.get_score(i))
    least = min(found.values(), default=0.0)
    for x in range(256):
        found.setdefault(bytes([x]), least - 1)
    return list(found), np.array(list(found.values()))


def first_scores(scores: np.ndarray) -> np.ndarray:
    """Log probabilities from a vocabulary's scores, the end piece last, as likely as the best piece: whole numbers are ranks, others log probabilities."""
    ranked = bool((scores == np.round(scores)).all())
    p = 1.0 / (scores.max() - scores + RANKED) if ranked else np.exp(scores - scores.max())
    p = np.append(p, p.max())
    return np.log(p / p.sum())


class Lattice:
    """Log probabilities, and expected piece counts, of words; words of one length are worked out together."""

    def __init__(self, pieces: list[bytes], logp: np.ndarray):
        self.logp = np.append(logp[: len(pieces)], _NONE)
        self.n = len(pieces)
        lengths = sorted({len(p) for p in pieces})
        self.longest = lengths[-1]
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        bits = 20
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.vals = np.zeros(1 << bits, np.uint64), np.full(1 << bits, self.n, np.int32)
        for i, h in enumerate(hashes):
            at = int((h ^ (h >> np.uint64(29))) & self.mask)
            while self.vals[at] != self.n:
                at = (at + 1) & int(self.mask)
            self.keys[at], self.vals[at] = h, i

    @staticmethod
    def _hash(b: bytes) -> int:
        h = 0
        for x in b:
            h = (h * 1_099_511_628_211 + x + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of the hashes; the number of pieces where there is none."""
        at = (h ^ (h >> np.uint64(29))) & self.mask
        out = self.vals[at]
        wrong = np.flatnonzero((out != self.n) & (self.keys[at] != h))
        while len(wrong):
            at[wrong] = (at[wrong] + np.uint64(1)) & self.mask
            out[wrong] = self.vals[at[wrong]]
            wrong = wrong[(out[wrong] != self.n) & (self.keys[at[wrong]] != h[wrong])]
        return out

    def _arcs(self, text: np.ndarray):
        """(i, j, piece numbers) of all substrings that some piece may be; text: words by bytes."""
        length = text.shape[1]
        for i in range(length):
            h = np.zeros(len(text), np.uint64)
            for j in range(i + 1, min(length, i + self.longest) + 1):
                h = h * _BASE + text[:, j - 1] + np.uint64(1)
                yield i, j, self._find(h)

    def _table(self, words: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1).astype(np.uint64)

    def forward(self, words: list[bytes]) -> np.ndarray:
        """Log probabilities of words of one length."""
        text = self._table(words)
        f = [np.zeros(len(words))] + [np.full(len(words), _NONE) for _ in range(text.shape[1])]
        for i, j, piece in self._arcs(text):
            hit = np.flatnonzero(piece != self.n)
            if len(hit):
                f[j][hit] = np.logaddexp(f[j][hit], f[i][hit] + self.logp[piece[hit]])
        return f[-1]

    def expected(self, words: list[bytes], counts: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected piece counts of words of one length, each taken counts times; sums are rescaled at each byte."""
        text = self._table(words)
        n, prob = text.shape[1], np.append(np.exp(self.logp[: self.n]), 0.0)
        arcs = [(i, j, p) for i, j, p in self._arcs(text)]
        into = [[] for _ in range(n + 1)]
        for i, j, p in arcs:
            into[j].append((i, p))
        # f[j] is scaled by the product of 1 / scale[k] for k up to j, so that every f[j] is 1.
        scale = [np.ones(len(words))]
        for j in range(1, n + 1):
            total = np.zeros(len(words))
            for i, p in into[j]:
                x = prob[p]
                for k in range(i + 1, j):
                    x = x / scale[k]
                total += x
            scale.append(np.maximum(total, 1e-300))
        b = [np.zeros(len(words)) for _ in range(n)] + [np.ones(len(words))]
        for i, j, p in sorted(arcs, key=lambda a: -a[1]):
            x = prob[p] * b[j]
            for k in range(i + 1, j + 1):
                x = x / scale[k]
            b[i] += x
            hit = np.flatnonzero(p != self.n)
            if len(hit):
                out += np.bincount(p[hit], counts[hit] * x[hit], self.n + 1)[: self.n]

    def arcs(self, word: bytes):
        """(starts, ends, piece numbers) of a word of any length, by start, a span of it at a time."""
        text = np.frombuffer(word, np.uint8).astype(np.uint64)
        for a in range(0, len(text), _SPAN):
            size = min(_SPAN, len(text) - a)
            h, starts, ends, pieces = np.zeros(size, np.uint64), [], [], []
            for n in range(1, self.longest + 1):
                on = min(size, len(text) - a - n + 1)
                if on <= 0:
                    break
                h = h[:on] * _BASE + text[a + n - 1 : a + n - 1 + on] + np.uint64(1)
                p = self._find(h)
                hit = np.flatnonzero(p != self.n)
                starts.append(hit + a)
                ends.append(hit + a + n)
                pieces.append(p[hit])
            starts, ends, pieces = np.concatenate(starts), np.concatenate(ends), np.concatenate(pieces)
            order = np.lexsort((ends, starts))
            yield starts[order], ends[order], pieces[order]

    def _sums(self, word: bytes) -> list[float]:
        """Log sums of all ways to each place of a word."""
        f = [_NONE] * (len(word) + 1)
        f[0] = 0.0
        for starts, ends, pieces in self.arcs(word):
            for i, j, s in zip(starts.tolist(), ends.tolist(), self.logp[pieces].tolist(), strict=True):
                x, y = f[i] + s, f[j]
                f[j] = (x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))) if y > _NONE else x
        return f

    def one(self, word: bytes) -> float:
        """Log probability of one word of any length."""
        return self._sums(word)[-1]

    def expected_one(self, word: bytes, count: float, out: np.ndarray) -> None:
        """Adds the expected piece counts of one word of any length, taken count times."""
        f = self._sums(word)
        b = [_NONE] * len(f)
        b[-1] = 0.0
        for starts, ends, pieces in reversed(list(self.arcs(word))):
            scores = self.logp[pieces]
            for i, j, s in zip(starts[::-1].tolist(), ends[::-1].tolist(), scores[::-1].tolist(), strict=True):
                x, y = b[j] + s, b[i]
                b[i] = (x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))) if y > _NONE else x
            # all that starts here is known: the sums behind it are final
            share = np.exp(np.minimum(0.0, np.array(f)[starts] + scores + np.array(b)[ends] - f[-1]))
            out += np.bincount(pieces, count * share, self.n + 1)[: self.n]


def tokens(text: bytes) -> list[bytes]:
    return text.translate(ASCII_LOWER).split()


def _count(batches):
    counts: Counter = Counter()

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])
        counts.clear()
        return rows

    for part, texts in blocks(batches):
        for t, held in zip(texts, part.column(part.schema.get_field_index("held_out")).to_pylist(), strict=True):
            if held:
                counts.update(dict.fromkeys(tokens(t), 0))
            else:
                counts.update(tokens(t))
            if len(counts) > 300_000:
                yield flush()
    if counts:
        yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (binary) and c of all words of docs(text, held_out), those of held-out texts counting nothing; added up before the shuffle."""
    return map_arrow(docs.select("text", "held_out"), _count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _by_length(batches, limit: int = 200_000):
    """Lists of words of one length, with their counts, from many batches at once."""
    held, rows = 0, defaultdict(list)
    for batch in batches:
        for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows[len(w)].append((w, c))
        held += batch.num_rows
        if held > limit:
            yield from rows.values()
            held, rows = 0, defaultdict(list)
    yield from rows.values()


def word_scores(counts: DataFrame, pieces: list[bytes], logp: np.ndarray) -> DataFrame:
    """counts with lp, each word's log probability over the lattice."""
    shared = counts.sparkSession.sparkContext.broadcast((pieces, logp))

    def run(batches):
        lattice = Lattice(*shared.value)
        for rows in _by_length(batches):
            for at in range(0, len(rows), 20_000):
                ws, cs = zip(*rows[at : at + 20_000], strict=True)
                lp = lattice.forward([b" " + w for w in ws]).tolist() if len(ws[0]) < WIDE else [lattice.one(b" " + w) for w in ws]
                yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array(cs, pa.int64()), pa.array(lp, pa.float64())], names=["word", "c", "lp"])

    return map_arrow(counts.select("word", "c"), run, "word binary, c long, lp double")


def fit_pieces(counts: DataFrame, ends: int, pieces: list[bytes], scores: np.ndarray) -> np.ndarray:
    """Log probabilities of pieces and end, by PASSES of expectation maximisation over all word counts."""
    ship(counts.sparkSession)
    logp = first_scores(scores)
    prior = np.exp(logp) * PRIOR * len(pieces)
    for _ in range(PASSES):
        shared = counts.sparkSession.sparkContext.broadcast((pieces, logp))

        def run(batches, shared=shared):
            lattice = Lattice(*shared.value)
            total = np.zeros(lattice.n)
            for rows in _by_length(batches):
                if len(rows[0][0]) >= WIDE:
                    for w, c in rows:
                        lattice.expected_one(b" " + w, float(c), total)
                    continue
                for at in range(0, len(rows), 5000):
                    ws, cs = zip(*rows[at : at + 5000], strict=True)
                    lattice.expected([b" " + w for w in ws], np.array(cs, np.float64), total)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(np.round(total[used] * UNIT).astype(np.int64))], names=["piece", "n"])

        sums = map_arrow(counts.select("word", "c"), run, "piece int, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()  # a row for each piece
        total = prior.copy()
        for r in sums:
            total[r.piece] += r.n / UNIT
        total[-1] += ends
        logp = np.log(total / total.sum())
    return logp


def lm_scores(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of docs(doc_id, text).

    Trains on the rows whose crc32 of doc_id as text is not HELD_OUT modulo FOLDS. A null or empty
    text has one token, its end. Repeated rows are scored and counted each; a null id counts as the
    empty text for its fold; other columns are ignored; an empty table gives no rows. path: a
    sentencepiece model that the driver can read; its pieces are broadcast (a vocabulary is bounded).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("held_out", crc_mod(F.col("doc_id"), FOLDS) == HELD_OUT)
    counts = cut(word_counts(docs), "counts")
    ends = docs.where(~F.col("held_out")).count()
    words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v"), F.count("*").alias("rows")).first()
    n, v = words.n + ends, words.v + (ends > 0)
    pieces, scores = load_pieces(path)
    logp = fit_pieces(counts.where("c > 0"), ends, pieces, scores)
    known = cut(word_scores(counts, pieces, logp), "words")
    head = {bytes(r.word): (r.c, r.lp) for r in known.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("c"), "word").limit(HEAD).collect()}
    denominator = math.log10(n + v + 1)
    shared, end = spark.sparkContext.broadcast(head), float(logp[-1])

    def run(batches):
        head = shared.value
        for part, texts in blocks(batches):
            rows, tails = [], []
            for t in texts:
                score, n_known, base, tail, n_tokens = end, int(ends > 0), math.log10(ends + 1) - denominator, [], 1
                for w, k in Counter(tokens(t)).items():
                    n_tokens += k
                    found = head.get(w)
                    if found is None:
                        tail.append({"word": w, "k": k})
                        continue
                    c, lp = found
                    score += k * lp
                    n_known += k if c else 0
                    base += k * (math.log10(c + 1) - denominator)
                rows.append((n_tokens, n_known, base, score))
                tails.append(tail)
            cols = list(zip(*rows, strict=True))
            kind = pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(part.schema.get_field_index("held_out")), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.float64()), pa.array(tails, kind)], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"])

    scored = map_arrow(docs, run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<struct<word:binary,k:bigint>>")
    last = F.lit(n).cast("long").alias("train_tokens")
    to_log10 = 1 / math.log(10)
    scored = cut(scored.withColumn("row", F.monotonically_increasing_id()), "scored")  # written, so a row keeps its number
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.k").join(known, "word")
    k = F.col("k")
    sums = tail.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, k).otherwise(0)).alias("more"), F.sum(k * (F.log10(F.col("c") + 1) - denominator)).alias("rest"), F.sum(k * F.col("lp")).alias("lps"))
    joined = scored.drop("tail").join(sums, "row", "left")
    zero = F.lit(0.0)
    return joined.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"), last, (F.col("base_score") + F.coalesce("rest", zero)).alias("base_score"), ((F.col("score") + F.coalesce("lps", zero)) * to_log10).alias("score"))
