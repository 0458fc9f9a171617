"""Every registered query against its SQL counterpart in DuckDB."""

import pytest
from compare import connect, differences

import __spark_entry__ as driver
from daymark import plans

# The training-data queries have tests of their own.
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, con, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == ""


def test_layout_report_counts_files_and_bytes(spark, tmp_path):
    from daymark.sources.layout import compare_layouts
    from daymark.sources.writers import sorted_write

    df = spark.range(5000).selectExpr("id", "id % 7 AS kind")
    for column in ("id", "kind"):
        sorted_write(df, str(tmp_path / column), column, 3)
    rows = compare_layouts(spark, {c: str(tmp_path / c) for c in ("id", "kind")}).collect()
    for r in rows:
        files = list((tmp_path / r.layout).glob("part-*"))
        assert (r.num_files, r.num_rows) == (3, 5000) and len(files) == 3
        assert r.size_bytes == sum(f.stat().st_size for f in files)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["host", "activity_dates", "as_of"] and df.count() == 5
