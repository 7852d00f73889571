"""Page extraction, phrase mining and vector codes against worked pages, brute force and odd rows."""

import hashlib
import random
import time
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from quizloom.llm import dom, extract, phrases, pq
from quizloom.llm.layouts import MARK, Setter

BLOG = """<!doctype html><html><head><title>x</title><style>a{}</style></head><body class="single"><a class="skip-link" href="#c">Skip to content</a>
<header id="masthead"><h1><a href="/">My Blog</a></h1><nav><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li></ul></nav></header>
<div id="content"><article id="post-1" class="post"><header class="entry-header"><h1>How to make Camembert</h1></header><div class="entry-content">
<p>Camembert is made from <b>cow's milk</b> &amp; needs three weeks.</p><p>First, warm the milk to 32&nbsp;&deg;C.<br>Then add the culture and wait.</p>
<div class="share"><h3>Share this:</h3><a href="#">Twitter</a></div></div></article>
<div id="comments"><ol class="comment-list"><li><p>I tried this last week and it turned out very well, thank you.</p><a>Reply</a></li></ol>
<form><label>Name</label><input><button>Post Comment</button></form></div></div><aside><h2>Recent Posts</h2><ul><li><a href="/b">Brie at home</a></li></ul></aside>
<footer><p>Proudly powered by cheese.</p></footer><script>var t = "</p>";</script></body></html>"""
BLOG_TEXT = "How to make Camembert\nCamembert is made from cow's milk & needs three weeks.\nFirst, warm the milk to 32 °C. Then add the culture and wait."
PLAIN = """<html><body><div id="nav"><a href="a">Home</a> | <a href="b">Contact</a></div><div><h1>The mill</h1><p>The mill was built in 1820 by two brothers who had come from the south.
<p>It burned down in 1904, and was never rebuilt.<p>Today a plaque marks the place.</div><div class="discussion"><p>guest: I lived near there as a child.</p></div><div id="legal">Imprint.</div></body></html>"""
PLAIN_TEXT = "The mill\nThe mill was built in 1820 by two brothers who had come from the south.\nIt burned down in 1904, and was never rebuilt.\nToday a plaque marks the place."


@pytest.fixture(scope="module")
def model():
    """Trained on set pages alone, as where no page of the table is marked."""
    return extract.fit(extract.labelled_pages([]))


def test_blocks_of_broken_markup():
    blocks, _ = dom.leaf_blocks('<p>a<p>b<b>c<br>d<div class="ad">e<!-- x > y -->f</div>g</p>h<ul><li>i<li>j<ul><li>k</ul>l</ul><a title="x>y">m</a>&amp;&lt;n</zz><td>o<SCRIPT>p</p></SCRIPT>q<')
    assert [b.text for b in blocks] == ["a", "bc d", "ef", "g", "h", "i", "j", "k", "l", "m&<n", "oq<"]
    assert [b.tag for b in blocks[:3]] == ["p", "p", "div"] and blocks[2].near and not blocks[3].near
    assert blocks[9].linked == 1


@pytest.mark.parametrize("page", ["<div>" * 200_000, '<a b="' * 100_000, "<!--" * 200_000, "<p>x</b>" * 100_000, "<li>" * 100_000, "<script>" * 100_000, "&" * 400_000, "<ul><li><div>" * 60_000, "<" * 300_000, "<p><td>" * 60_000])
def test_blocks_take_linear_time(page):
    began = time.time()
    dom.leaf_blocks(page)
    assert time.time() - began < 6


def test_pages_by_hand(model):
    assert extract.main_text(BLOG, model) == BLOG_TEXT
    assert extract.main_text(PLAIN, model) == PLAIN_TEXT


def test_held_out_layouts(model):
    rng, right, blocks = random.Random(77), 0, 0
    prose = [" ".join(rng.choice(["river", "stone", "walks", "the", "under", "old", "bridge,", "and", "quiet."]) for _ in range(rng.randint(4, 60))) for _ in range(200)]
    for _ in range(150):
        page = Setter(rng, rng.choices(prose, k=5)).page("A walk by the river", rng.choices(prose, k=rng.randint(1, 12)))

        got, labels = extract._marked(page)
        scores = [sum(model[0].get(n, 0.0) for n in f) for f in extract.features(got)]
        right += sum(a == b for a, b in zip(extract.viterbi(scores, model[1]), labels))
        blocks += len(labels)
    assert right / blocks > 0.97


def test_viterbi_equals_enumeration():
    rng = random.Random(3)
    for _ in range(50):
        scores, pairs = [rng.uniform(-2, 2) for _ in range(rng.randint(1, 9))], np.array([[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)])
        value = lambda y: sum(s for s, v in zip(scores, y) if v) + sum(pairs[a, b] for a, b in zip(y, y[1:]))
        every = [[n >> i & 1 for i in range(len(scores))] for n in range(1 << len(scores))]
        assert value(extract.viterbi(scores, pairs)) == pytest.approx(max(map(value, every)))


def test_extraction_of_table_pages_and_odd_rows(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = extract.extract_text(pages, extract.train(pages)).join(pages.select("page_id", "html"), "page_id").collect()
    for r in got:
        want = [b.text for b in dom.leaf_blocks(r.html)[0] if b.any >> dom.NAMES.index("<article>") & 1]
        assert r.text == "\n".join(want) and r.n_chars == len(r.text)
    long = "<p>" + "word " * 200_000 + ".</p>"
    rows = [(1, "u", None, "x"), (None, None, "", "y"), (2, "u", PLAIN, "z"), (2, "u", PLAIN, "z"), (3, "u", "no markup at all", ""), (4, "u", f"<article>{long}</article>", ""), (5, "u", "<article><p>The page was cut within a tag, as it was saved. It ends here, <scr", "")]
    out = extract.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), model).collect()
    assert out[0].text == out[1].text == "" and out[2] == out[3] and out[2].text == PLAIN_TEXT
    assert out[5].n_chars == 5 * 200_000 + 1 and out[6].text.endswith("It ends here,")
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract.extract_text(none, extract.train(none)).collect() == []


def brute_phrases(rows, least, top=2000):
    words, grams = {}, {}
    for text, lang in rows:
        lang, t = "und" if lang is None else lang, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\x0b\x0c\r":
            t = t.replace(c, "\n")
        for piece in t.split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            words.setdefault(lang, Counter()).update(w)
            for k in range(2, 6):
                grams.setdefault(lang, Counter()).update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, per in grams.items():
        n, cand = sum(words[lang].values()), {g: a for g, a in per.items() if a >= least}
        count = lambda g: words[lang][g[0]] if len(g) == 1 else per[g]
        rows = []
        for g, a in cand.items():
            if any(len(h) > len(g) and 100 * b >= 100 * a and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)) for h, b in cand.items()):
                continue
            s, k = min((1000 * a * n // (count(g[:k]) * count(g[k:])), k) for k in range(1, len(g)))
            rows.append((-s, -a, " ".join(g).encode(), count(g[:k]), count(g[k:])))
        out += [(lang, i + 1, p.decode(), -a, le, r, n, -s) for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


@pytest.mark.parametrize("head", [phrases.HEAD, 4, 0])
def test_phrases_equal_brute_force(spark, monkeypatch, head):
    monkeypatch.setattr(phrases, "HEAD", head)
    monkeypatch.setattr(phrases, "MIN_COUNT", 7)
    monkeypatch.setattr(phrases, "BLOCK", 300)
    monkeypatch.setattr(phrases, "CHUNK", 64)
    monkeypatch.setattr(phrases, "RANGE_ROWS", 100)
    monkeypatch.setattr(phrases, "TOP", 25)
    rng = random.Random(4)
    vocabulary = ["a", "b", "b", "B", "été", "\0", "名前", "x" * 90, "rare%d"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(vocabulary).replace("%d", str(i)) + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ", ", "\r\n"]) for _ in range(rng.randint(0, 30)))
        rows.append((text, rng.choice(["en", "en", "en", None, "und", ""])))
    rows += [(None, "en"), ("", None), ("a b été a b été a b été " * 40, "en")] + [("the same text of many words, over and over", "xx")] * 9
    got = phrases.collocations(spark.createDataFrame([(*r, "z") for r in rows], "text string, lang string, word string"))
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 7, 25)


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None)], "text string, lang string")).collect() == []


def brute_codes(rows, entries, rounds):
    """(vec_id, code, error, label_error) and the codebooks' digest, by plain integers."""
    kept = [(i, [floor(1024 * Fraction(float(v))) for v in x], y) for i, x, y in rows if x and len(x) % 4 == 0 and all(v is not None and np.isfinite(v) for v in x)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(kept[0][1]) // 4
    kept = [r for r in kept if len(r[1]) == 4 * dim]
    part = lambda x, p: x[p * dim : (p + 1) * dim]
    books = [[part(x, p) for _, x, _ in kept[:entries]] for p in range(4)]

    def nearest(x, p):
        return min((sum((a - b) ** 2 for a, b in zip(part(x, p), e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for _, x, _ in kept:
                groups.setdefault(nearest(x, p)[1], []).append(part(x, p))
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    found = [(i, [nearest(x, p) for p in range(4)], y) for i, x, y in kept]
    per = Counter()
    for _, near, y in found:
        per[y] += sum(d for d, _ in near)
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    most = pq.MOST
    return sorted(((i, "".join(f"{k:02x}" for _, k in near), min(most, sum(d for d, _ in near)), min(most, per[y])) for i, near, y in found), key=str), digest


@pytest.mark.parametrize("case", ["plain", "ties", "few", "huge"])
def test_codes_equal_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(pq, "BLOCK_ROWS", 50)
    monkeypatch.setattr(pq, "HOT", 3)
    rng = random.Random(case)
    draw = {"plain": lambda: rng.gauss(0, 1), "ties": lambda: rng.choice([0.0, 0.001, -0.001, 0.25]), "few": lambda: rng.gauss(0, 3), "huge": lambda: rng.choice([1e30, -3e20, 1e12, 0.5, -0.5])}[case]
    rows = [(i * 7 % 1001, [draw() for _ in range(8)], rng.choice([None, "a", "a", "a", f"l{i % 9}"])) for i in range(8 if case == "few" else 150 if case == "huge" else 400)]
    rows += [(5000, None, "a"), (5001, [None] * 8, "a"), (5002, [float("nan")] * 8, "b"), (5003, [float("inf")] + [0.0] * 7, "b"), (5004, [], None), (5005, [0.5] * 4, None), (5006, [0.5] * 9, None), rows[3], rows[3], (None, [draw() for _ in range(8)], None)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label string, code int, row string")
    got = pq.vector_codes(df, entries=12).collect()
    want, digest = brute_codes(rows, 12, 4)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_heaps_leave_most_parts_unread(monkeypatch):
    """In the last rounds of clear groups hardly a part is compared again, and codes stay exact."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (12, 16))
    x = centres[rng.integers(0, 12, 3000)] + rng.integers(-30, 30, (3000, 16))
    books = [[list(map(int, e)) for e in centres[:, p * 4 : p * 4 + 4]] for p in range(4)]
    now = pq.Round(books, np.zeros((4, 12)))
    data, kind = pq._store(x)
    block = pq._assign({"dim": 16, "x": data, "kind": kind, "entry": None, "heap": None, "slack": None}, now)
    nearer = pq.Round([[[v + 1 for v in e] for e in b] for b in books], now.moved + 2 * 2.0001)
    read = []
    whole = pq.Round.nearest
    monkeypatch.setattr(pq.Round, "nearest", lambda self, part, p: read.append(len(part)) or whole(self, part, p))
    again = pq._assign(block, nearer)
    assert sum(read) < 600
    entry = np.frombuffer(again["entry"], np.int16).reshape(4, -1)
    for p in range(4):
        assert (entry[p] == whole(nearer, x[:, p * 4 : p * 4 + 4], p)[0]).all()


def test_codes_of_no_usable_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (2, [float("nan")] * 4, 3)], "vec_id long, embedding array<float>, label int")
    assert pq.vector_codes(df).collect() == [] and pq.vector_codes(df.limit(0)).collect() == []
    assert MARK and len(pq.vector_codes(df).columns) == 5
