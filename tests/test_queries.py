"""Every engine query against its SQL in DuckDB, and the plans of some."""

import math
from pathlib import Path

import duckdb
import pytest

from tendril.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="the given tables aren't here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "-"
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)[:10] if hasattr(v, "year") else str(v)
    return repr(float(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_its_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    want = duck.execute(registry.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_gives_rows(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_prune(spark):
    text = plan(registry.QUERIES["d05_h34_sums"](spark, DATA))
    assert "Python" not in text and "ReadSchema" in text and "l_comment" not in text
    assert "IsNotNull(l_orderkey)" in text
    features = plan(registry.QUERIES["i04_award_features"](spark, DATA))
    assert "Python" not in features and "SortAggregate" not in features and features.count("WindowGroupLimit") == 2
    assert features.count("FileScan") == 3  # awards are derived once
