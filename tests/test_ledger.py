"""Appends that a lost job can't spoil, and first rows on a stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from quizloom.operators import records as rc
from quizloom.sources.ledger import Conflict, Ledger
from quizloom.streaming.ingest import append_ledger_stream, first_wins_stream


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("format", ["json", "parquet"])
def test_appends_and_reruns(spark, tmp_path, format):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 2), (None, 3)], "id string, n int")
    store = Ledger(spark, str(tmp_path / "s"), df.schema, format)
    assert store.read().count() == 0 and store.commits() == []
    assert store.append(df, "id", ["n"]) == (3, 1)
    assert store.append(df, "id", ["n"]) == (0, 4)
    assert rows(store.read()) == rows(df.where("n <> 1"))
    assert store.append(df.limit(0), "id", ["n"]) == (0, 0)
    assert [c["rows"] for c in store.commits()] == [3, 0, 0]


def test_a_job_lost_between_write_and_commit(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    store = Ledger(spark, str(tmp_path / "s"), df.schema)
    store.append(df.where("id = 'a'"), "id", ["n"], "one")

    def lost(self, number, counts):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Ledger, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            store.append(df, "id", ["n"], "two")
    assert rows(store.read()) == rows(df.where("id = 'a'"))  # written, not seen
    assert store.append(df, "id", ["n"], "two") == (1, 1)
    assert store.append(df, "id", ["n"], "two") == (1, 1)  # told again, not added again
    assert rows(store.read()) == rows(df)
    with monkeypatch.context() as m:
        m.setattr(Ledger, "_commit", lost)
        with pytest.raises(RuntimeError, match="lost"):
            store.append(spark.createDataFrame([("c", 3)], df.schema), "id", ["n"], "three")
    assert store.sweep() == ["three"] and rows(store.read()) == rows(df)


def test_cut_commits_and_conflicts(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("a", 1)], "id string, n int")
    store = Ledger(spark, str(tmp_path / "s"), df.schema)
    store.append(df, "id", ["n"], "one")
    (tmp_path / "s/commits/000000000002.json").write_text('{"batch": "tw')
    assert len(store.commits()) == 1 and store.append(df, "id", ["n"]) == (0, 1)
    assert json.loads((tmp_path / "s/commits/000000000003.json").read_text())["collided"] == 1
    monkeypatch.setattr(Ledger, "_next", lambda self: 1)
    with pytest.raises(Conflict):
        store.append(df.withColumn("id", F.lit("z")), "id", ["n"])
    assert rows(store.read()) == rows(df)


def test_new_and_collided_keep_every_row(spark):
    new = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 5, "x"), (None, 1, "x"), (None, 1, "x"), ("c", 1, "x")], "k string, n int, `row` string")
    known = spark.createDataFrame([("c",), ("c",)], "k string")
    got, rest = rc.new_and_collided(new, known, "k", ["n"])
    assert rows(got) == sorted(["Row(k='a', n=1, row='x')", "Row(k='b', n=5, row='x')", "Row(k=None, n=1, row='x')"])
    assert rows(rest) == sorted(["Row(k='a', n=1, row='x')", "Row(k='a', n=2, row='y')", "Row(k=None, n=1, row='x')", "Row(k='c', n=1, row='x')"])
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    hit = rc.lookup(spark.createDataFrame([("a", 1), (None, 2)], "k string, mine int"), new.select("n", "row").withColumn("key", F.lit("a")), F.col("k"), F.col("key"), ["n"])
    assert {(r.k, r.mine, r.n, r.row) for r in hit.collect()} == {("a", 1, 1, "x"), (None, 2, None, None)}


def test_streams(spark, tmp_path):
    src, batches = tmp_path / "in", [[("a", 3, 0), ("a", 1, 1), ("b", 9, 1)], [("a", 0, 2), ("c", 4, 3), ("c", 4, 3)], [("b", 1, 4), ("d", 2, 5), (None, 1, 5)]]
    src.mkdir()
    out = []
    for n, batch in enumerate(batches):
        lines = [{"id": i, "n": k, "ts": f"2024-01-01T00:0{t}:00Z", "batch": n} for i, k, t in batch]
        (src / f"{n}.json").write_text("\n".join(map(json.dumps, lines)))
        os.utime(src / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))  # a stream reads files in the order of their times
        out += lines
    schema = "id string, n int, ts timestamp, batch int"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
    query = first_wins_stream(stream, "id", ["n"], "ts").writeStream.format("memory").queryName("firsts").outputMode("append").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    table = spark.read.schema(schema).json(str(src))
    assert rows(spark.table("firsts")) == rows(rc.first_wins(table.where("id IS NOT NULL"), ["id"], ["batch", "n"]))
    store = Ledger(spark, str(tmp_path / "s"), table.schema)
    for _ in range(2):  # the second time from a lost checkpoint: nothing is added twice
        append_ledger_stream(spark, str(src), table.schema, store, str(tmp_path / f"c{2 + _}"), ["n"], files=1).awaitTermination(120)
    assert rows(store.read().where("id IS NOT NULL")) == rows(rc.first_wins(table.where("id IS NOT NULL"), ["id"], ["batch", "n"]))
