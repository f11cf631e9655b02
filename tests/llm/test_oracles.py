"""The registered queries on the smallest tables: those with SQL against DuckDB, all for their columns and row counts."""

import duckdb
import pytest

from fleetpulse.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql(spark, con, name):
    got = registry.queries()[name](spark, SF)
    cols = sorted(got.columns)
    rel = con.sql(registry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({registry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, want))


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql()) - {"pipeline", "op11_bidiagonal_whitening"}))
def test_one_row_per_input_row(spark, con, name):
    table = "pages" if name.startswith("op1_") else "documents"
    n = con.sql(f"SELECT count(*) FROM {table}").fetchall()[0][0]
    assert registry.queries()[name](spark, SF).count() == n
