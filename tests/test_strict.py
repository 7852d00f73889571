"""Strict loading of three parts: every failure, in order, with lines and files."""

import json

import pytest

from quizloom.schema import CorpusInvalid
from quizloom.sources import strict

GOOD = {"id": "a", "org": "o", "ccaa": "c", "fecha": "2020", "turno": None, "num": 1, "bloque": None, "q": "What?", "opts": ["x", "y"], "resp": "A", "resp_verificada": True, "conf": 1, "origen": "html", "penalizacion": None, "reserva": False}


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines), encoding="utf-8")


def test_all_failures_in_order(spark, tmp_path):
    without = {k: v for k, v in GOOD.items() if k not in ("num", "reserva")}
    write(tmp_path, "b.jsonl", GOOD | {"id": "x"}, "", '{"id": "cut', GOOD | {"id": "a", "conf": 1.5}, "[1, 2]")
    write(tmp_path, "a.jsonl", GOOD, GOOD | {"id": "y", "resp": "E"}, GOOD | {"id": "z", "resp_verificada": False}, GOOD)
    write(tmp_path, "c.jsonl", without | {"id": "w", "q": "  ", "opts": [], "penalizacion": "much"}, GOOD | {"id": "v", "resp_verificada": "yes", "resp": None}, GOOD | {"id": "x", "opts": "x"}, GOOD | {"id": 5, "conf": True}, GOOD | {"id": 5})
    write(tmp_path, "corpus.jsonl", "not read")
    write(tmp_path, "my_cuarentena_2.jsonl", "nor this")
    got = [(r.file, r.line, r.id, r.why) for r in strict.failures(spark, str(tmp_path)).orderBy("file", "line", "seq").collect()]
    assert got == [
        ("a.jsonl", 2, "y", "verified without a valid letter"),
        ("a.jsonl", 3, "z", "letter without verification"),
        ("a.jsonl", 4, "a", "repeated id, first in a.jsonl"),
        ("b.jsonl", 3, None, "unreadable JSON"),
        ("b.jsonl", 4, "a", "confidence outside 0 to 1"),
        ("b.jsonl", 4, "a", "repeated id, first in a.jsonl"),
        ("b.jsonl", 5, None, "unreadable JSON"),
        ("c.jsonl", 1, "w", "missing num"),
        ("c.jsonl", 1, "w", "missing reserva"),
        ("c.jsonl", 1, "w", "no options"),
        ("c.jsonl", 1, "w", "empty stem"),
        ("c.jsonl", 1, "w", "penalty outside 0 to 1"),
        ("c.jsonl", 1, "w", "reserve not boolean"),
        ("c.jsonl", 2, "v", "verification not boolean"),
        ("c.jsonl", 2, "v", "verified without a valid letter"),
        ("c.jsonl", 3, "x", "no options"),
        ("c.jsonl", 3, "x", "repeated id, first in b.jsonl"),
    ]
    with pytest.raises(CorpusInvalid) as e:
        strict.load_strict(spark, str(tmp_path), show=4)
    assert str(e.value).split("\n") == ["17 problems in the corpus:", "  a.jsonl:y: verified without a valid letter", "  a.jsonl:z: letter without verification", "  a.jsonl:a: repeated id, first in a.jsonl", "  b.jsonl:3: unreadable JSON"]


def test_lines_of_a_part_in_many_splits(spark, tmp_path):
    """Line numbers and first files hold where one file is read by many tasks."""
    lines = [GOOD | {"id": f"i{n % 990}"} if n % 100 else "{" for n in range(1000)]
    write(tmp_path, "big.jsonl", *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        found = strict.failures(spark, str(tmp_path))
        assert strict.part_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        rows = found.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.line for r in rows if r.id is None) == [n + 1 for n in range(0, 1000, 100)]
    assert sorted(r.line for r in rows if r.why.startswith("repeated")) == list(range(992, 1001))


def test_a_whole_corpus_loads(spark, tmp_path):
    write(tmp_path, "a.jsonl", "﻿" + json.dumps(GOOD), GOOD | {"id": "b", "resp": None, "resp_verificada": False}, "  ")
    corpus = strict.load_strict(spark, str(tmp_path))
    assert corpus.unverified().count() == 1
    empty = tmp_path / "none"
    empty.mkdir()
    write(empty, "x.jsonl", "")
    assert strict.failures(spark, str(empty)).collect() == []


def test_lines_are_parsed_once_whatever_uses_their_records(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "x"}\n{"id": "x"}\n')
    found = strict.failures(spark, str(tmp_path))
    assert "parse_json" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert found.where("why like 'repeated id%'").count() == 1
