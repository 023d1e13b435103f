"""Driver contract: entry runs, every key is registered, and a sample of
keys agrees with its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "cnt"]
    assert df.count() > 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize(
    "key",
    ["conform_trips", "monthly_counts", "load_backlog", "reconcile_counts", "sample_per_month", "newest_file",
     "url_file_name", "header_file_name", "numbered_names", "quoted_path", "retire_empty_month", "ledger_replace",
     "file_head", "hot_month_publish", "table_reload_month", "conform_missing", "conform_bad_values", "null_rows",
     "null_key_violations", "range_violations", "numbered_names_existing", "header_forms", "ledger_compact",
     "split_month_files", "mixed_folder_scan", "jdbc_ledger_replace", "catalog_listing"],
)
def test_oracle_agrees(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted(tuple(str(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
