import __spark_entry__ as E


def test_entry_and_registry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 100 and df.columns == ["word", "freq"]
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 60
    from mergeloom import catalog
    assert set(catalog.QUERIES) - {"train_bpe_2000", "encode_2000"} == set(catalog.ORACLES)


def test_oracle_sql_binds():
    import duckdb

    from .conftest import SF_SMALL
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute("EXPLAIN " + sql)
