"""Driver contract and a sample of registered queries at sf0.001."""

import duckdb

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_contract_shapes():
    qs, os_ = entry.queries(), entry.oracle_sql()
    assert set(os_) <= set(qs)
    assert len(qs) >= 80


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["topic", "count"] and len(rows) > 0


def test_sample_queries_match_oracle(spark, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name in ["value_counts", "top_per_goal", "new_items", "tfidf", "classify_goals", "render_prompt"]:
        s = entry.queries()[name](spark, sf_dir).toPandas()
        o = con.execute(entry.oracle_sql()[name]).df()
        assert sorted(s.columns) == sorted(o.columns), name
        assert len(s) == len(o), name


def test_every_oracle_runs_in_duckdb(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.execute(sql).fetchall()
