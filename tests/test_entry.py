"""Driver contract: entry() runs, every oracle key is a registered query, 2.A keys match DuckDB at sf0.001."""

import duckdb

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
QUICK = ["validate_genes", "validate_interactome", "validate_cross", "harmonize_genes", "harmonize_interactome",
         "harmonize_gwas_rare", "harmonize_diseases", "ledger_eta", "interaction_graph", "rank_genes"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"sourceDatabase", "targetA", "intA", "targetB", "intB", "count", "scoring"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return repr(round(v, 9)) if isinstance(v, float) else repr(v)


def test_quick_keys_match_duckdb(spark, sf0001):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf0001}/{t}.parquet')")
    sql = E.oracle_sql()
    for name in QUICK:
        df = E.queries()[name](spark, sf0001)
        cols = df.columns
        srows = sorted(tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect())
        res = con.execute(sql[name])
        dcols = [d[0] for d in res.description]
        assert sorted(dcols) == sorted(cols), name
        order = sorted(range(len(dcols)), key=lambda i: dcols[i])
        drows = sorted(tuple(_norm(r[i]) for i in order) for r in res.fetchall())
        assert srows == drows, name
