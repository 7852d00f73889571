"""Term automaton, pattern rules and staged rules against regular expressions and worked cases."""

import random
import re
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quizloom.operators import classify as cl
from quizloom.operators import rules as rl
from quizloom.operators import terms as tm


def by_regex(text, terms):
    pattern = lambda t: rf"\b{re.escape(t[:-1])}" if t.endswith("~") else rf"\b{re.escape(t)}\b"
    return [i for i, t in enumerate(terms) if re.search(pattern(t), text or "")]


def test_terms_equal_regular_expressions():
    rng = random.Random(1)
    for _ in range(300):
        terms = tuple(dict.fromkeys("".join(rng.choice("abñ5 -/") for _ in range(rng.randint(1, 4))) + rng.choice(["", "~"]) for _ in range(30)))
        terms = tuple(t for t in terms if t != "~")
        text = "".join(rng.choice("aab bñ5 -/_.") for _ in range(rng.randint(0, 60)))
        assert tm.found(text, terms) == by_regex(text, terms)


def test_terms_read_a_text_once():
    text = " ".join(f"word{i % 997}" for i in range(200_000))
    took = []
    for n in (10, 5_000):
        terms = tuple(f"word{i}" for i in range(n))
        tm.found("", terms)
        began = time.time()
        tm.found(text, terms)
        took.append(time.time() - began)
    assert took[1] < 20 * took[0] + 0.5  # five hundred times as many terms


def test_terms_bounds_and_odd_rows(spark, monkeypatch):
    t = tm.Terms(spark, ["abc", "", None, "~", "abc", "ab~"])
    assert t.terms == ("abc", "ab~")
    df = spark.createDataFrame([(None, 1), ("", 2), ("x abcd", 3), ("abc.abc", 4), ("abc.abc", 4)], "text string, i int")
    assert [r.h for r in df.select(t.hits(F.col("text")).alias("h")).collect()] == [[], [], [1], [0, 1], [0, 1]]
    assert {r.term: r.n for r in tm.term_counts(df, tm.Terms(spark, ["abc", "zz"]), F.col("text")).collect()} == {"abc": 2, "zz": 0}
    monkeypatch.setattr(tm, "MOST", 1)
    with pytest.raises(ValueError, match="too many"):
        tm.Terms(spark, ["a", "b"])
    with pytest.raises(ValueError, match="too many"):
        tm.Terms.of(spark.createDataFrame([("a",), ("b",)], "term string"))


def test_pattern_rules(spark):
    table = spark.createDataFrame([(2, "b", "ley", 5), (1, "a", r"\bley 5\b", 4), (3, "c", "nunca jamas", 6), (2, "bb", "l.y", 7)], "ord int, name string, pattern string, topic int")
    rules = rl.PatternRules.of(table)
    df = spark.createDataFrame([(1, "La Ley 5 dice", "x"), (2, "LÉY 6", "y"), (3, None, "z"), (4, "", "z"), (5, "otra", "z")], "id int, q string, hit string")
    got = {r.id: (r.rule, r.topic) for r in rules.apply(df).collect()}
    assert got == {1: ("a", 4), 2: ("b", 5), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert rules.apply(df).columns == ["id", "q", "hit", "rule", "topic", "evidence"]
    assert "Ley 5" in rules.apply(df).where("id = 1").first().evidence
    assert {r.name: (r.ord, r.hits, r.shadowed) for r in rules.report(df).collect()} == {"a": (1, 1, 0), "b": (2, 1, 1), "bb": (3, 0, 2), "c": (4, 0, 0)}
    assert {r.rule for r in rl.PatternRules([]).apply(df).collect()} == {None}


STAGED = [
    rl.Rule("norm", 1, [["ley 14/1986", "general de sanidad"]], 'norm "{}"'),
    rl.Rule("tie", 26, [["dolor", "analgesi~"], ["escala", "eva"]], "scale of pain"),
    rl.Rule("tie", 21, [["respiratori~"], ["nino", "pediatr~"]], "breathing, children"),
    rl.Rule("tool", 19, [["test de constant", "escala"]], 'tool "{}"'),
    rl.Rule("word", 44, [["vendaje", "tape"]], 'word "{}"'),
]


@pytest.mark.parametrize(
    ("q", "opts", "want"),
    [
        ("La Ley 14/1986, general de sanidad", ["escala"], (1, "norm", 'norm "ley 14/1986"', "stem")),  # the first stage, the first term in the list's order
        ("Escala EVA de dolor", [], (26, "tie", "scale of pain", "stem")),  # both of a joint condition
        ("Analgésicos y escalas", ["una escala"], (26, "tie", "scale of pain", "all")),  # the second half only with the options
        ("Dolor de espalda", ["nada"], (None, None, "no sign", None)),  # one half is not enough
        ("La escala de algo", ["respiratoria en pediatría"], (19, "tool", 'tool "escala"', "stem")),  # the stem settles it before the options are read
        ("¿Cuál es?", ["test de Constant", "vendaje"], (19, "tool", 'tool "test de constant"', "all")),
        ("Un vendaje con tape", None, (44, "word", 'word "vendaje"', "stem")),
        ("vendajes", ["x"], (None, None, "no sign", None)),
        (None, None, (None, None, "no sign", None)),
        (None, ["tape"], (44, "word", 'word "tape"', "all")),
    ],
)
def test_staged_rules(spark, q, opts, want):
    df = spark.createDataFrame([(1, q, opts, "kept")], "id int, q string, opts array<string>, hits string")
    r = rl.decide(df, STAGED).first()
    assert (r.topic, r.stage, r.reason, r.scope) == want and r.hits == "kept"


def test_staged_rules_from_a_table_and_their_agreement(spark):
    order = ["norm", "tie", "tool", "word"]
    rows = [(order.index(r.stage), r.stage, i, r.topic, r.groups, r.reason) for i, r in reversed(list(enumerate(STAGED)))]
    table = spark.createDataFrame(rows, "stage_order int, stage string, ord int, topic int, groups array<array<string>>, reason string")
    assert rl.staged_rules(table) == STAGED
    df = spark.createDataFrame([("a", "vendaje", None), ("b", "escala", None), ("c", "nada", None), ("d", "tape", None)], "id string, q string, opts array<string>")
    gold = spark.createDataFrame([("a", 44, None), ("b", 3, 19), ("c", 2, None), ("d", 1, 2), ("lost", 1, 2)], "id string, topic int, second int")
    r = rl.agreement(gold, rl.decide(df, STAGED)).first()
    assert (r.ok, r.wrong, r.undecided, r.missing, r.decided, r.total, r.agreement, r.coverage) == (2, 1, 1, 1, 3, 4, 0.666667, 0.75)
    assert rl.decide(df, []).select("topic", "reason").distinct().collect() == [(None, "no sign")]
    assert rl.decide(df.limit(0), STAGED).collect() == []


def test_lexicon_from_a_table(spark):
    table = spark.createDataFrame([(7, "masaje", 2), (7, "friccion~", 2), (3, "agua", 1), (3, "calor", 2), (3, None, 2), (None, "x", 1), (9, "agua", 1)], "topic int, term string, weight int")
    lexicon = cl.Lexicon.of(table)
    rows = [(1, "Masaje y fricciones", ["calor"]), (2, "agua", []), (3, "agua y calor", None), (4, None, ["masaje", "calor"]), (5, "masaje", ["calor y agua", "friccion"]), (6, "masaje", ["masaje"]), (7, "calor y masaje", [])]
    got = {r.id: (r.topic, r.second_topic, r.why) for r in cl.classify(spark.createDataFrame(rows, "id int, q string, opts array<string>"), [], lexicon).collect()}
    assert got == {1: (7, 3, "lexicon:4"), 2: (None, None, "weak"), 3: (3, 9, "lexicon:3"), 4: (None, None, "weak"), 5: (7, 3, "lexicon:3"), 6: (7, None, "lexicon:2"), 7: (None, 7, "tie")}


def test_a_batch_of_texts_is_not_copied_into_strings():
    texts = pa.array([None, ""] + [f"alpha {'x' * 20_000} beta{i}" for i in range(500)])
    terms_ = ("alpha", "beta~", "gamma")
    tm.found("alpha", terms_)  # the automaton is built
    tracemalloc.start()
    got = tm.found_in(texts.slice(1), terms_)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.type == pa.list_(pa.int32()) and got.to_pylist() == [[]] + [[0, 1]] * 500
    assert peak < texts.nbytes / 20


def test_batches_to_python_workers_are_bounded_in_bytes(spark):
    import pyarrow as pa

    from quizloom.session import ship

    ship(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "size"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("repeat(cast(id % 10 as string), 10000) AS t").mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in rows) == 3000 and max(r.size for r in rows) < 6 << 20
