"""Every registered query against its SQL in DuckDB on the smallest tables."""

import datetime
import decimal
import glob
import math

import duckdb
import pytest

from tidegraph.plans import registry


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return str([plain(v) for v in value])
    return repr(value)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rsplit('/', 1)[1][:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    found = registry.queries()[name](spark, sf_dir)
    names = sorted(found.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in found.collect())
    if name in registry.oracle_sql():
        result = duck.execute(registry.oracle_sql()[name])
        columns = [c[0] for c in result.description]
        assert sorted(columns) == names
        at = [columns.index(c) for c in names]
        assert rows == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def test_citations_of_any_order_are_known(spark, tmp_path):
    spark.createDataFrame([(1, "see 19999, 25000 and 149999"), (2, "no order 777777")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(19999,), (25000,), (149999,)], "o_orderkey long").write.parquet(f"{tmp_path}/orders.parquet")
    found = registry.queries()["citation_check"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["cited"], r["unknown"]) for r in found) == [(1, 3, 0), (2, 1, 1)]
