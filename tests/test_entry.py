import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and "llm_context" in entry.queries()


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["paper_id", "text", "visual_pages"] and df.count() > 0


@pytest.mark.parametrize("name", ["p5_found", "clean_text", "repeated_noise", "llm_context", "validate_document", "incremental_plan", "verify_store", "aimd_trace"])
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(DATA):
        db.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    mine = entry.queries()[name](spark, DATA)
    cols = sorted(mine.columns)
    theirs = db.execute(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, mine.select(*cols).collect()))) == sorted(map(repr, theirs))
