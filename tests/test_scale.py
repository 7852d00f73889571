"""The catalogue's SQL at more than one scale: a cut that fits the smallest tables would show here."""

import os

import duckdb
import pytest

from quizloom.plans import catalogue

SF = "/root/testdata/sf0.1"
#: Queries whose answers change in kind with the number of rows.
NAMES = ["html_questions", "index_left_match", "scanned_questions", "sectioned_questions", "syllabus_topics", "compact_payload", "download_totals", "page_marks"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="the larger tables aren't here")
@pytest.mark.parametrize("name", NAMES)
def test_larger_tables(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        if t.endswith(".parquet"):
            con.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{t}')")
    df = catalogue.queries()[name](spark, SF)
    cur = con.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(str([r[names.index(c)] for c in order]) for r in cur.fetchall())
    assert sorted(str([r[c] for c in order]) for r in df.collect()) == want
