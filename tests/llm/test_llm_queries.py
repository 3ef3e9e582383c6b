import os

import pytest

from folioflow.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
COLUMNS = {
    "p1_found": ["field", "key_a", "key_b"], "p2_found": ["embedding_id", "first_embedding_id"], "p3_found": ["field", "term", "mark"], "p4_found": ["paper_id", "page_number", "line_no", "kind"],
    "p6_found": ["paper_id", "page_number", "line_no"], "p7_found": ["name_a", "name_b"], "p10_found": ["doc_id"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_found_queries_have_their_columns_and_no_row_twice(spark, name):
    df = Q.QUERIES[name](spark, DATA)
    rows = df.collect()
    assert df.columns == COLUMNS[name] and len(rows) == len(set(rows))
    if "key_a" in df.columns or "name_a" in df.columns:
        assert all(r[-2] < r[-1] for r in rows)


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for f in os.listdir(DATA):
        db.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{DATA}/{f}'")
    mine = Q.QUERIES[name](spark, DATA)
    cols = sorted(mine.columns)
    theirs = db.execute(f"SELECT {', '.join(cols)} FROM ({Q.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, map(tuple, mine.select(*cols).collect()))) == sorted(map(repr, theirs))
