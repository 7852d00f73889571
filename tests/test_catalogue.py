"""The question-corpus operators: rules of the record contract, parsers, and each query against its SQL."""

import math
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quizloom import schema
from quizloom.functions import text as tx
from quizloom.operators import metadata as md
from quizloom.operators import metrics as mx
from quizloom.operators import records, reports
from quizloom.operators import similarity as sim
from quizloom.operators import study as st
from quizloom.plans import catalogue
from quizloom.schema import Corpus, CorpusInvalid, Verified
from quizloom.sources import files, layout, lines, parsers
from quizloom.streaming.ingest import append_stream, daily_counts

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def shown(rows):
    one = lambda x: round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted((str(tuple(None if x is None or x != x else one(x) for x in r)) for r in rows))


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    want = duck.execute(catalogue.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(cols)
    assert shown(map(tuple, got.select(*cols).collect())) == shown(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, name):
    assert catalogue.queries()[name](spark, SF).count() >= 0


BASE = ("X-1", "X", "Y", None, None, 1, None, "A stem that is long enough:", ["a", "b", "c", "d"], "A", True, 1.0, "test", 0.0, False)


@pytest.mark.parametrize(("field", "value", "fails"), [(None, None, 0), ("resp", "Z", 1), ("conf", 1.5, 1), ("penalizacion", 7.0, 1), ("penalizacion", None, 0), ("reserva", None, 1), ("opts", [], 1), ("resp_verificada", False, 1)])
def test_contract(spark, field, value, fails):
    row = [value if f.name == field else v for f, v in zip(schema.RECORD, BASE, strict=True)]
    df = spark.createDataFrame([row], schema.RECORD)
    assert len(df.select(schema.violations(df).alias("v")).first().v) == fails
    if fails:
        with pytest.raises(CorpusInvalid):
            Corpus.load(df)
    else:
        assert Corpus.load(df).verified().df.count() == 1


def test_answers_need_verified_records(spark):
    df = spark.createDataFrame([BASE], schema.RECORD)
    with pytest.raises(TypeError):
        mx.letter_distribution(Corpus(df))
    with pytest.raises(Exception, match="unverified"):
        Verified(df.selectExpr("*").withColumn("resp_verificada", df.resp_verificada & False)).df.count()


def test_t_distribution():
    assert math.isclose(mx.t_two_sided(2.228139, 11), 0.05, abs_tol=1e-6)
    assert round(mx.t_two_sided(4.0, 3106), 4) == 0.0001


HTML = """<form name="pregunta07"><p>7. What is <b>this</b> &amp; that&nbsp;thing?<br/></p>
<input type="radio" onclick="respuesta07('Incorrecto')">a) One thing<br><input type="radio" onclick="respuesta07('Correcto')"/>b) Two <i>things</i><br/>
<input type="radio" onclick="respuesta07('Incorrecto')"/>c) Three<br/><input type="radio" onclick="respuesta07('Incorrecto')"/>d) Four<input type="text" name="resultado"/></form><form><input type="text"></form>"""


def test_pages(spark):
    pages = [("a", HTML), ("b", HTML.replace("Correcto", "Incorrecto").replace("InIncorrecto", "Incorrecto")), ("c", HTML.replace("7. What", "9. What")), ("d", None), ("e", "")]
    got = {r.file: r for r in parsers.parse_pages(spark.createDataFrame(pages, "url string, html string")).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert len(got) == 3 and (a.num, a.q, a.opts, a.right_index, a.fails) == (7, "What is this & that thing?", ["One thing", "Two things", "Three", "Four"], 1, [])
    assert b.right_index is None and b.fails and c.num == 9 and c.warnings and not c.fails


def _lines(spark, texts, page=1, doc="d"):
    return spark.createDataFrame([(doc, page, i, t, 0.9) for i, t in enumerate(texts)], "doc string, page int, line_no int, text string, conf double")


def test_scans(spark):
    seen = [tx.look_alike_number(F.lit(t)) for t in ("1", "|", "l |", "lO", "95", "ab")]
    assert list(spark.range(1).select(*seen).first()) == [1, 1, 11, 10, 95, None]
    texts = ["cover", "1. First stem", "goes on", "8. not a new one", None, " ", "a) one", "8) two", "c) three", "more", "d) four", "e) five", "l. second time", "2. Second stem"]
    got = parsers.parse_scans(_lines(spark, texts).union(_lines(spark, ["1. Other", "a) x"], doc="e"))).orderBy("doc", "num").collect()
    a, b, c = got
    assert a.q == "First stem goes on 8. not a new one" and a.opts == ["one", "two", "three more", "four e) five l. second time"] and a.conf <= 0.99
    assert a.warnings == ["option 8 where b was due"] and b.num == 2 and (c.doc, c.q, c.opts) == ("e", "Other", ["x"])
    strict = parsers.parse_scans(_lines(spark, ["1. First", "b) not yet", "a) one", "c) no", "b. two", "9) no", "6. Far ahead", "4. Ahead"]), strict_letters=True).orderBy("num").collect()
    assert [(r.num, r.q, r.opts) for r in strict] == [(1, "First b) not yet", ["one c) no", "two 9) no 6. Far ahead"]), (4, "Ahead", [])]
    assert strict[1].warnings == ["expected 2, found 4"] and parsers.parse_scans(_lines(spark, ["no question"])).count() == 0


def test_sections(spark):
    texts = ["TEORICO", "1 First", "A) a", "B) b", "A) no option", "C) c", "D) d", "CASO PRACTICO 1: a man", "of 40", "2 Second of", "A) a", "B) b", "C) c", "D) d", "3 No question", "200 Out of range", "4 Fourth", "A) a", "Página 3 de 4"]
    got = parsers.parse_sections(_lines(spark, texts, page=3), [("theory", 3, 21, 1, 100), ("practice", 22, 34, 101, 150)]).orderBy("num").collect()
    assert [(r.num, r.q, r.opts, r.context) for r in got] == [
        (1, "First", ["a", "b A) no option", "c", "d"], None), (2, "Second of 3 No question 200 Out of range", ["a", "b", "c", "d"], "CASO PRACTICO 1: a man of 40"), (4, "Fourth", ["a"], "CASO PRACTICO 1: a man of 40"),
    ]
    assert parsers.parse_sections(_lines(spark, texts, page=50), [("theory", 3, 21, 1, 100)]).count() == 0


def test_link_contexts_equal_brute_force(spark):
    rng = random.Random(3)
    pages = [(i, "".join(rng.choice(['<a href="u1">one</a>', '<a href="u2">', "<b>x</b> ", "word  ", "é\n", '<a href="u3"></a>']) for _ in range(rng.randint(0, 40)))) for i in range(30)] + [(99, None)]
    best = {}
    for i, h in pages:
        for m in re.finditer('href="([^"]+)"', h or ""):
            text = re.sub(r"\s+", " ", re.sub("<[^>]+>", " ", h[max(0, m.start() - 20) : m.end() + 20])).strip()
            if m[1] not in best or len(text) > len(best[m[1]][0]):
                best[m[1]] = (text, i)
    got = layout.link_contexts(spark.createDataFrame(pages, "page_id int, html string"), 'href="([^"]+)"', 20)
    assert {r.url: (r.ctx, r.page) for r in got.collect()} == best


def test_complete_only_and_quarantine(spark, tmp_path):
    q = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2), ("c", 9), ("d", 1)], "category string, num int")
    g = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("c", 2)], "category string, num int")
    assert {r.category: (r.state, r.numbers) for r in reports.category_states(q, g, 2).collect()} == {"a": ("complete", ""), "b": ("gaps", "2"), "c": ("outside", "9"), "d": ("no grid", "")}
    assert reports.complete_only(q, g, 2).select("category").distinct().first().category == "a"
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, why string")
    out = str(tmp_path / "q")
    assert files.append_quarantine(df, out, ["id"]) == 2 and files.append_quarantine(df, out, ["id"]) == 0
    cache = str(tmp_path / "c")
    assert files.write_cache(df, cache) == 2 and files.write_cache(df.union(df), cache) == 0
    text = reports.write_report([("ids", reports.report(df, "%s: %s", "id", "why"))], str(tmp_path / "r"))
    assert text == "== ids ==\na: x\nb: y\n" and [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == text.rstrip("\n").split("\n")
    assert files.write_jsonl(df, str(tmp_path / "j")) == 2 and files.write_jsonl(df, str(tmp_path / "k"), dry_run=True) == 2
    with pytest.raises(ValueError):
        files.filled_page("<html>", "/*DATA*/", F.lit("{}"))


def test_pages_read_in_any_encoding(spark, tmp_path):
    for name, data in (("a.html", "é€".encode()), ("b.htm", "é€".encode("cp1252")), ("c.txt", b"\xef\xbb\xbfx"), ("d.pdf", b"no")):
        (tmp_path / name).write_bytes(data)
    with pytest.warns(UserWarning):
        got = files.read_pages(spark, str(tmp_path), str(tmp_path / "none"))
    assert {r.path.rsplit("/", 1)[1]: r.text for r in got.collect()} == {"a.html": "é€", "b.htm": "é€", "c.txt": "x"}
    (tmp_path / "arr.json").write_text('[{"id": "a"}, {"id": "b"}]')
    assert sorted(r.id for r in files.read_json_array(spark, str(tmp_path / "arr.json"), "id string").collect()) == ["a", "b"]


def test_empty_inputs(spark):
    none = lambda t: spark.createDataFrame([], t)
    assert parsers.parse_scans(none("doc string, page int, line_no int, text string, conf double")).count() == 0
    assert layout.scan_lines(none("doc int, page int, block int, par int, line int, word_no int, text string, conf double")).count() == 0
    assert layout.placed_grid(none("doc int, page int, x double, y double, text string, conf int, width int")).count() == 0
    assert reports.category_states(none("category string, num int"), none("category string, num int"), 3).count() == 0
    assert mx.family_summary(none("id string, family string, topic int, org string, year int, pos int"), "family").count() == 0
    assert mx.sittings(none("q string, org string, fecha string")).count() == 0
    r = reports.confidence_summary(none("conf double")).first()
    assert (r.n, r["mean"], r.least) == (0, 0.0, 0.0) and reports.payload_meta(none("topic int, fam int")).first().n == 0
    assert records.islands(none("u int, t int"), "u", "t", lambda a, b: b - a > 1).count() == 0 and records.whole_groups(none("g int, x int"), "g", F.col("x") > 0).count() == 0



def test_linkage_and_leaders(spark):
    df = spark.createDataFrame([(1, ["aa", "bb", "cc"]), (2, ["aa", "bb", "dd"]), (3, ["bb", "dd", "ee"]), (4, []), (5, ["zz"])], "id long, t array<string>")
    got = {r.id: r.leader for r in sim.leaders(df, "id", "t", 0.5).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_leaders_by_brute_force(spark):
    rng = random.Random(7)
    sets = [sorted(rng.sample("abcdefgh", rng.randint(0, 4))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, t array<string>")
    want, lead = {}, []
    for i, x in enumerate(sets):
        alike = [j for j in lead if x and sets[j] and len({*x} & {*sets[j]}) / len({*x} | {*sets[j]}) >= 0.6]
        want[i] = min(alike, default=i)
        lead += [i] * (want[i] == i)
    assert {r.id: r.leader for r in sim.leaders(df, "id", "t", 0.6).collect()} == want


def test_cosine_blocks(spark):
    x = np.random.default_rng(3).normal(size=(90, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(90, None), (91, [1.0])]
    got = sim.cosine_pairs(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 0.4, block=16).collect()
    d = 1 - x @ x.T
    assert sorted((r.a, r.b) for r in got) == [(i, j) for i in range(90) for j in range(i + 1, 90) if d[i, j] < 0.4]
    assert all(abs(r.distance - d[r.a, r.b]) < 1e-12 for r in got)


def test_keys(spark):
    df = spark.createDataFrame([("Nº 1ª  Él, ¡Ñandú…!",)], "q string")
    r = df.select(tx.key("q").alias("a"), tx.key_removed("q").alias("b"), tx.fold_upper("q").alias("c")).first()
    assert (r.a, r.b) == ("no 1a el nandu", "no 1a el nandu") and r.c.startswith("NO 1A")


def test_files(spark, tmp_path):
    p = str(tmp_path / "a.jsonl")
    with open(p, "w") as f:
        f.write('{"id": "a", "q": "x"}\n\nnot json\n')
    got = files.read_jsonl(spark, p).orderBy("at").collect()
    assert [(r.id, r._corrupt) for r in got] == [("a", None), (None, "not json")]
    assert [(r.line, r._corrupt) for r in files.bad_lines(spark, p).collect()] == [(3, "not json")]
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    out = os.path.join(tmp_path, "out")
    assert files.append_new(df, out, ["id"], df.schema) == (2, 1)
    assert files.append_new(df, out, ["id"], df.schema) == (0, 3)


def test_study_formulas(spark):
    assert math.isclose(st.least_coverage(40.0), 0.416667, abs_tol=1e-6) and st.least_coverage(0) == 0 and st.least_coverage(80) == 1
    df = spark.createDataFrame([(1, 0, 1.0, 2026, "a"), (None, None, 0.0, 2016, "b"), (3, 3, 0.5, 2030, None)], "h int, m int, c double, year int, r string")
    got = df.select(st.mastery(F.col("h"), F.col("m")), st.mark(F.col("c")), st.likelihood(F.col("year"), F.col("r"), {"a": 1.0})).collect()
    want = [(2 / 3, 68.0, 1.0), (0.5, 20.0, 0.5 * math.exp(-1)), (0.5, 44.0, 0.5)]
    assert all(math.isclose(x, y) for a, b in zip(got, want, strict=True) for x, y in zip(a, b, strict=True))


def test_priorities_and_files(spark):
    t = spark.createDataFrame([(1, 2.0, 15.0), (2, 2.0, 1.0), (3, 2.0, 0.0), (4, 2.0, 1.0)], "topic int, expected double, hours double")
    assert [(r.topic, r.chosen) for r in st.priorities(t, 1.5).orderBy("rank").collect()] == [(3, True), (2, True), (4, False), (1, False)]
    f = spark.createDataFrame([("a", 1, False), ("a", 2, False), ("b", 1, False), ("b", 3, False), ("c", 1, True), ("d", None, False)], "file string, num int, bad boolean")
    assert {r.file: r.state for r in st.file_report(f, "file", "num", F.col("bad")).collect()} == {"a": "clean", "b": "quarantine", "c": "quarantine", "d": "quarantine"}


def test_bold_questions(spark):
    rows = [("cover", 1.0), ("1.- First stem", 0.9), ("goes on", 0.8), ("a) one", 0.0), ("more", 0.1), ("b) two", 0.0), ("26 de junio, no number", 1.0), ("7. not a question", 1.0), ("9. Third", 1.0), ("a) x", 0.0), (None, 1.0)]
    df = spark.createDataFrame([("d", 1, i, t, b) for i, (t, b) in enumerate(rows)], "doc string, page int, line_no int, text string, bold double")
    a, b = lines.bold_questions(df).orderBy("num").collect()
    assert (a.q, a.opts, a.misnumbered) == ("First stem goes on 26 de junio, no number 7. not a question", ["one more", "two"], False)
    assert (b.num, b.printed, b.q, b.opts, b.misnumbered) == (2, 9, "Third", ["x"], True)


def test_syllabus_and_feed(spark):
    rows = ["TEMA 9: Before any section", "PARTE GENERAL", "TEMA 1: First topic. Its rest", "goes  on", "núm. 12", "PARTE ESPECÍFICA", "stray", "TEMA 2. Second: more"]
    df = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(rows)], "doc string, page int, line_no int, text string")
    assert sorted((r.section, r.num, r.text) for r in lines.syllabus(df).collect()) == [("general", 1, "First topic. Its rest goes on"), ("specific", 2, "Second: more")]
    df = spark.createDataFrame([("d", 1, i, t) for i, t in enumerate(["1. First topic. Its rest", "goes on", "2. Second: more"])], "doc string, page int, line_no int, text string")
    assert {r.topic: r.name for r in lines.topic_names(df).collect()} == {1: "First topic", 2: "Second"}
    feed = '{"feed": {"entry": [{"title": {"$t": "Colección X"}, "link": [{"rel": "self", "href": "s"}, {"rel": "alternate", "href": "u"}]}, {"title": {"$t": "Other"}, "link": []}]}}'
    assert [tuple(r) for r in lines.feed_entries(spark.createDataFrame([(feed,), ("no json",)], "value string")).collect()] == [("Colección X", "u")]


def test_metadata(spark):
    df = spark.createDataFrame([("SESCAM 2020", "A", "2020", "2020-05-01"), ("Osakidetza", "A", "2019", "2021"), ("nothing", "A", None, "2021"), ("x", "Z", "2020-01-02", "")], "t string, o string, i string, d string")
    hints = {"A": ["SESCAM"], "B": ["OSAKIDETZA", "EJ"]}
    got = df.select(md.org_agrees(F.col("t"), F.col("o"), hints), md.dates_agree(F.col("i"), F.col("d")), md.first_given(F.col("d"), F.col("i"))).collect()
    assert [tuple(r) for r in got] == [(True, True, "2020-05-01"), (False, False, "2021"), (None, True, "2021"), (None, True, "2020-01-02")]
    old = spark.createDataFrame([("1", "2025-01-01", "Q", {"a": "x", "c": "z"}, "b", "T9"), ("2", None, "R", {}, None, None)], "id string, fecha_examen string, enunciado string, opciones map<string,string>, respuesta_correcta string, tema string")
    new = md.translated(old, {"org": "O"}).orderBy("id").collect()
    assert [(r.opts, r.resp, r.tema_primario, r.org) for r in new] == [(["x", "", "z", ""], "B", 9, "O"), (["", "", "", ""], "", None, "O")]


def test_streams_equal_tables(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([("a", "q"), ("b", "q"), ("b", "r")], "id string, q string")
    df.write.json(src)
    for _ in range(2):  # the second run finds nothing new
        append_stream(spark, src, df.schema, out, str(tmp_path / "ckpt")).awaitTermination(60)
    assert sorted(r.id for r in spark.read.json(out).collect()) == ["a", "b"]
    events = spark.read.parquet(f"{SF}/events.parquet")
    stream = spark.readStream.schema(events.schema).parquet(f"{SF}/events.parquet*")
    q = daily_counts(stream).writeStream.format("memory").queryName("days").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert shown(map(tuple, spark.table("days").collect())) == shown(map(tuple, daily_counts(events).collect()))


def test_sign_bounds_are_those_of_sql(spark):
    """A letter beyond ASCII after a word ends it in SQL: 'no esñ' holds 'no es'."""
    texts = ["mira no esñ x", "no este", "ñexcepto", "excepto_", "EXCEPTO", "falsa1", "es falsaé", "a\\b"]
    df = spark.createDataFrame([(t, "A", True) for t in texts], "q string, resp string, resp_verificada boolean")
    got = {r.sign: r.n for r in mx.negation_by_letter(Corpus(df).verified()).collect()}
    con = duckdb.connect()
    want = sum(con.execute("SELECT regexp_matches(?, ?)", [t, mx.NEGATIVE.replace("(?iu)", "(?i)")]).fetchone()[0] for t in texts)
    assert got == {"negative": want, "positive": len(texts) - want} and want == 4
    assert tx.ascii_bounds(r"\\b\d") == r"\\b\d"


def test_keys_take_one_pass_and_equal_the_plain_steps(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("aB9 é.ñ\t\n\r\x0b\x0c\u00a0-ß½x") for _ in range(rng.randint(0, 40))) for _ in range(400)] + [None, "", " . "]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.fold("t").alias("f"), tx.key("t").alias("k"), tx.key_removed("t").alias("r"))
    for r in df.collect():
        if r.f is not None:
            assert r.k == re.sub(" +", " ", re.sub("[^a-z0-9 ]", " ", r.f)).strip(" ")
            assert r.r == re.sub(r"[ \t\n\x0b\f\r]+", " ", re.sub(r"[^a-z0-9 \t\n\x0b\f\r]", "", r.f)).strip(" ")
    plan = catalogue.queries()["normalised_keys"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1  # the texts are folded once


def test_collisions_read_the_texts_once(spark):
    plan = catalogue.queries()["collision_anti"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "documents" not in plan and not re.search(r"Relation \[doc_id#\d+L,text#", plan)  # only the known texts are left to read
