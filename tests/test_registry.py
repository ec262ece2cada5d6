import __spark_entry__ as entry
from flowcube.plans import registry
from flowcube.operators import olap
from tests.conftest import SF_SMALL

# Keys without SQL.
NO_ORACLE = set()


def test_every_query_has_an_oracle():
    q, o = registry.queries(), registry.oracle_sql()
    assert set(q) - set(o) == NO_ORACLE
    assert set(o) <= set(q)
    assert len(q) >= 95
    assert set(q) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "revenue_cents", "orders", "items"]
    assert df.count() > 0


def test_mart_schema_is_dims_plus_additive_measures(spark):
    m = entry.queries()["mart_monthly"](spark, SF_SMALL)
    assert m.columns == olap.MART_COLUMNS
    assert not [c for c in m.columns if any(p in c for p in ("order", "ticket"))]


def test_every_query_equals_its_sql_on_the_smallest_data(spark):
    import duckdb

    from flowcube.sources.tables import TABLES
    from tools.check import digest

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = registry.oracle_sql()
    wrong = []
    for name, fn in registry.queries().items():
        df = fn(spark, SF_SMALL)
        want = con.sql(sql[name])
        rows, expected = [tuple(r) for r in df.collect()], want.fetchall()
        if sorted(df.columns) != sorted(want.columns) or digest(df.columns, rows)[0] != digest(want.columns, expected)[0]:
            wrong.append(name)
    assert not wrong
