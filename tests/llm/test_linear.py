"""Contexts and spans of personal data in time that grows with the text, equal to the plain definitions."""

import random
import re
import time

import pytest

from quizloom.llm import components, pii, simhash

#: Contexts by one expression, which tries each place.
PLAIN = re.compile(r"(?s).{0,24}(?:[0-9+(][0-9 ().+/-]{6,}|[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+).{0,2}")


def test_contexts_equal_one_expression():
    rng = random.Random(3)
    for _ in range(4000):
        t = "".join(rng.choice(["a", "b9", " ", "@", "@x.y", "+49 30 1234567", "12345678", ".", ",", "(", "ab@cd.e", "\n", "é", "1"]) for _ in range(rng.randint(0, 40)))
        assert pii.contexts(t) == PLAIN.findall(t)


@pytest.mark.parametrize("text", ["12345678a" * 100_000, "a" * 1_000_000 + "@b.c", "ab@cd.e," * 100_000, "@" * 500_000])
def test_contexts_take_linear_time(text):
    began = time.time()
    pii.contexts(text)
    assert time.time() - began < 8


def test_reach_equals_every_span():
    rng = random.Random(4)
    for _ in range(2000):
        spans = [(a := rng.randint(0, 60), a + rng.randint(1, 15), "ip") for _ in range(rng.randint(0, 8))]
        r, a = pii._Reach(spans), rng.randint(0, 60)
        b = a + rng.randint(1, 12)
        assert r.holds(a, b) == any(x <= a and b <= y for x, y, _ in spans)
        assert r.meets(a, b) == any(x < b and a < y for x, y, _ in spans)


def test_many_addresses_and_phones():
    """A text of many base spans among many regions."""
    text = "me@site.org or +49 30 1234567 on 12.03.2021; " * 6000
    began = time.time()
    base, every = pii.find(text, {})
    assert sum(k == "email" for _, _, k in base) == 6000 and len(every) >= len(base) and time.time() - began < 20


def test_simhash_broadcasts_no_side_that_grows_with_fingerprints(spark, monkeypatch):
    """With Spark's own threshold: the side of 66 rows a fingerprint and the minima of nodes stay off the driver."""
    plans = []
    written = components.cut

    def noted(df, name="cut"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(components, "cut", noted)
    fps = simhash.fingerprints(spark.createDataFrame([(i, f"a b c d {i // 2}") for i in range(60)], "doc_id long, text string"))
    found = simhash.links(fps.select("fp").distinct())
    dealt = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in dealt and "BuildLeft" not in dealt
    components.components(fps.selectExpr("fp u", "fp - 1 v").distinct())
    assert len(plans) > 1 and not any("BroadcastHashJoin" in p for p in plans)


def test_keep_one_joins_what_stays_without_a_broadcast(spark):
    docs = spark.createDataFrame([(i, f"a b c d {i // 2}") for i in range(60)], "doc_id long, text string")
    kept = simhash.keep_one(docs)
    kept.collect()
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()
