import __spark_entry__ as entry
from tidewater.plans.queries import QUERIES


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "event_type", "cnt"]
    assert df.count() > 0


def test_every_engine_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_build_on_smoke_data(spark):
    from .conftest import SF_SMALL
    for name, q in QUERIES.items():
        df = q(spark, SF_SMALL)
        assert df.columns, name
