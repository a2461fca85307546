import duckdb
import pytest

from tidewater.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.LLM_ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    res = con.execute(queries.LLM_ORACLE[name])
    cols = sorted(d[0] for d in res.description)
    at = [[d[0] for d in res.description].index(c) for c in cols]
    want = sorted(tuple(r[i] for i in at) for r in res.fetchall())
    df = queries.LLM_QUERIES[name](spark, SF)
    assert sorted(df.columns) == cols
    assert sorted(tuple(r) for r in df.select(*cols).collect()) == want
