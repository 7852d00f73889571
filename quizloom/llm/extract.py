"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi.

A block's features are its element and its parent's, what its ancestors' elements and names say, its
length, links, punctuation and set phrases, and its neighbours' lengths and links. Two labels
and the weights of their transitions are trained by the conditional likelihood of whole pages:
pages of the table that mark their article, and their texts set in other layouts (layouts.py).
"""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quizloom.llm.common import map_arrow
from quizloom.llm.dom import HINTS, NAMES, Block, leaf_blocks
from quizloom.llm.layouts import MARK, PROSE, Setter

#: Pages of the training sample, how many times as many are drawn by hash, code points of one, layouts that each is set in, passes, and the size of steps and penalty.
SAMPLE, SPARE, SHORT, LAYOUTS, PASSES, STEP, DECAY = 240, 2, 100_000, 3, 150, 0.15, 1e-3
#: Set phrases of boilerplate.
_CUES = {
    "rights": r"©|\(c\) \d{4}|copyright|all rights reserved|tous droits|alle rechte|derechos reservados|impressum|privacy policy|terms of (use|service)|datenschutz|mentions légales|aviso legal",
    "cookie": r"\bcookies?\b|\bgdpr\b|\bdsgvo\b|javascript",
    "subscribe": r"newsletter|subscribe|sign up|log ?in|abonnieren|abonnez|suscríb",
    "share": r"^(share|tweet|teilen|partager|compartir|print|email|like)\b|facebook|twitter|whatsapp",
    "reply": r"^(reply|antworten|répondre|responder)\b|\bsays:$|\bwrote\b.{0,20}\bago$|leave a (comment|reply)|\bcomments?$|kommentare?$|commentaires?$|comentarios?$",
    "advert": r"^(advertisement|anzeige|publicité|publicidad|sponsored)\b|click here|limited offer",
    "related": r"^(related|most read|you may also|trending|read more|more from|das könnte|à lire|te puede)",
}
_CUE = {k: re.compile(p, re.I) for k, p in _CUES.items()}
_LINKS, _WORDS = (0.0, 0.3, 0.7), (1, 2, 5, 10, 20, 40, 80)
#: Code points of the longest block that set phrases are looked for in.
_SAYING = 300
_INSIDE = 1 << NAMES.index("<article>") | 1 << NAMES.index("<main>")
_ASIDE = sum(1 << NAMES.index(n) for n in ("talk", "side", "menu"))


def _shape(b: Block, words: int) -> tuple[int, int]:
    share = b.linked / len(b.text)
    return sum(share > x for x in _LINKS), sum(words >= x for x in _WORDS)


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of each block's features."""
    out, shapes = [], [_shape(b, b.text.count(" ") + 1) for b in blocks]
    within = [bool(b.any & _INSIDE) and not b.any & _ASIDE for b in blocks]
    told = any(within)
    for i, b in enumerate(blocks):
        link, words = shapes[i]
        hints = b.any & ((1 << len(HINTS)) - 1)
        f = ["bias", f"t:{b.tag}", f"p:{b.parent}", f"l{link}", f"lw{link}{words}", f"n:{b.near}", f"h:{hints}"]
        f += [f"w{k}" for k in range(1, words + 1)]  # each bound passed, so that longer than any seen is as long
        f += [f"a:{n}" for k, n in enumerate(NAMES) if b.any >> k & 1]
        f.append(f"in:{told}:{within[i]}")
        f += [f"m:{n}" for k, n in enumerate(HINTS) if b.near >> k & 1]
        if not hints:
            f.append(f"bare:{words}:{link}")
        t = b.text
        f.append("end" if t[-1] in ".?!…。\"”»" else "open")
        if "," in t:
            f.append("comma")
        if len(t) <= _SAYING:
            f += [f"c:{k}" for k, p in _CUE.items() if p.search(t)]
        f += [f"<{'%d%d' % shapes[i - 1]}" if i else "<first", f">{'%d%d' % shapes[i + 1]}" if i + 1 < len(blocks) else ">last"]
        out.append(f)
    return out


def viterbi(scores: list[float], pairs: np.ndarray) -> list[int]:
    """The best labels of blocks with these scores of label 1 against 0; pairs: weights of a label after another."""
    if not scores:
        return []
    (aa, ab), (ba, bb) = pairs.tolist()
    zero, one, back = 0.0, scores[0], []
    for s in scores[1:]:
        to0, to1 = (zero + aa, one + ba), (zero + ab, one + bb)
        back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
        zero, one = max(to0), max(to1) + s
    out = [int(one > zero)]
    for b in reversed(back):
        out.append(b[out[-1]])
    return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], passes: int = PASSES) -> tuple[dict[str, float], np.ndarray]:
    """Weights of features for label 1, and of transitions, that maximise the pages' conditional likelihood, by full gradients with adaptive steps.

    Pages are kept side by side; forward and backward sums of all go block by block.
    """
    pages = [p for p in pages if p[0]]
    names: dict[str, int] = {}
    sizes = np.array([len(f) for page, _ in pages for f in page])
    flat = np.array([names.setdefault(n, len(names)) for page, _ in pages for f in page for n in f])
    gold = np.array([y for _, labels in pages for y in labels])
    edge = np.append(0, np.cumsum(sizes)[:-1])
    lengths = np.array([len(p) for p, _ in pages])
    first = np.append(0, np.cumsum(lengths)[:-1])
    longest = int(lengths.max())
    there = [np.flatnonzero(lengths > i) for i in range(longest)]
    w, pairs = np.zeros(len(names)), np.zeros((2, 2))
    follow = np.ones(len(gold), bool)
    follow[first] = False
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:-1][follow[1:]], gold[1:][follow[1:]]), 1)
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)]
    for step in range(1, passes + 1):
        s = np.zeros((len(gold), 2))
        s[:, 1] = np.add.reduceat(w[flat], edge)
        fwd, bwd = s.copy(), np.zeros_like(s)
        for i in range(1, longest):
            at = first[there[i]] + i
            fwd[at] += np.logaddexp(fwd[at - 1, :1] + pairs[0], fwd[at - 1, 1:] + pairs[1])
        for i in range(longest - 1, 0, -1):
            at = first[there[i]] + i
            t = s[at] + bwd[at]
            bwd[at - 1] = np.logaddexp(pairs[:, 0] + t[:, :1], pairs[:, 1] + t[:, 1:])
        joint = fwd + bwd
        total = np.logaddexp(joint[:, 0], joint[:, 1])
        slope = gold - np.exp(joint[:, 1] - total)
        after = np.flatnonzero(follow)
        expect = np.exp(fwd[after - 1][:, :, None] + pairs + (s[after] + bwd[after])[:, None, :] - total[after][:, None, None]).sum(0)
        grads = np.bincount(flat, np.repeat(slope, sizes), len(names)) / len(pages) - DECAY * w, (seen - expect) / len(pages) - DECAY * pairs
        for value, grad, k in ((w, grads[0], 0), (pairs, grads[1], 2)):
            moments[k] = 0.9 * moments[k] + 0.1 * grad
            moments[k + 1] = 0.999 * moments[k + 1] + 0.001 * grad**2
            value += STEP * (moments[k] / (1 - 0.9**step)) / (np.sqrt(moments[k + 1] / (1 - 0.999**step)) + 1e-8)
    return {n: float(w[i]) for n, i in names.items()}, pairs


def _marked(html: str) -> tuple[list[Block], list[int]]:
    """Blocks of a page set by layouts.py, the mark taken off, and their labels."""
    blocks, _ = leaf_blocks(html)
    return [b._replace(text=" ".join(b.text.replace(MARK, "").split()) or ".") for b in blocks], [int(MARK in b.text) for b in blocks]


def labelled_pages(pages: list[str], layouts: int = LAYOUTS, seed: int = 1) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of pages that mark one article, and of their texts in other layouts."""
    rng, out, told = random.Random(seed), [], []
    inside = 1 << NAMES.index("<article>")
    for page in pages:
        blocks, seen = leaf_blocks(page)
        labels = [int(bool(b.any & inside)) for b in blocks]
        if seen["article"] == 1 and 0 < sum(labels):
            out.append((features(blocks), labels))
            told.append(([b for b, y in zip(blocks, labels) if y], [b.text for b, y in zip(blocks, labels) if not y]))
    prose = [b.text for main, _ in told for b in main if b.tag == "p"][:2000] or PROSE
    for n in range(SAMPLE * layouts):
        if told:
            main, rest = told[n % len(told)]
            title = next((b.text for b in main if b.tag == "h1"), "")
            texts = [b.text for b in main if b.tag != "h1"]
        else:
            title, texts, rest = rng.choice(PROSE)[:40], rng.choices(PROSE, k=rng.randint(1, 9)), []
        others = rng.choices(prose, k=6) + [t for t in rest if " " in t][:4]
        texts = texts[: rng.randint(1, 40)]
        if rng.random() < 0.3:
            texts += rng.choices(PROSE, k=2)
        blocks, labels = _marked(Setter(rng, others).page(title, texts))
        out.append((features(blocks), labels))
    return out


def train(pages: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """A model from SAMPLE pages at most of those of up to SHORT code points that mark an article, in the order of a hash of the html.

    Where no page is marked, fixed sentences are set in layouts.
    """
    # Only hashes under a bound are put in order, so that tasks don't each send the driver a sample.
    share = min(1.0, SPARE * SAMPLE / max(1, pages.count()))
    order = F.pmod(F.xxhash64("html"), F.lit(1 << 40))
    short = pages.where((F.char_length("html") <= SHORT) & F.col("html").contains("<article") & (order <= int(share * (1 << 40))))
    drawn = short.select("html", order.alias("order")).distinct().orderBy("order", "html").limit(SAMPLE).collect()
    return fit(labelled_pages([r.html for r in drawn]))


def main_text(page: str, model: tuple[dict[str, float], np.ndarray]) -> str:
    weights, pairs = model
    blocks, _ = leaf_blocks(page)
    scores = [math.fsum(weights.get(n, 0.0) for n in f) for f in features(blocks)]
    return "\n".join(b.text for b, y in zip(blocks, viterbi(scores, pairs)) if y)


def extract_text(pages: DataFrame, model: tuple[dict[str, float], np.ndarray]) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages(page_id, url, html).

    A null or empty html has an empty text. A page that ends within a tag or a script ends before it; one of any
    length is read once, whole. Equal pages give equal texts; ids and urls may be null or repeated; other columns
    are not read, whatever their names; an empty table gives no rows.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    told = pages.sparkSession.sparkContext.broadcast(model)  # as many weights as SAMPLE pages have features

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [main_text(h or "", told.value) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    schema = T.StructType([*rows.schema.fields[:2], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return map_arrow(rows, run, schema)
