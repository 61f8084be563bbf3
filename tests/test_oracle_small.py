"""Spark result of representative keys vs their DuckDB SQL twins on the
smallest fixture, and independence from the shuffle partition count."""

import math

import duckdb
import pytest

from tests.conftest import SF
from vigil.catalog import TABLES
from vigil.plans import registry

KEYS = ["clean_incidents", "guarded_drop", "describe_numeric", "describe_categorical",
        "positive_rate_by_group", "score_histogram", "group_crosstab", "fairness_summary",
        "cv_results", "dq_report", "page_chunks", "one_hot", "lineage_raw", "flagship"]


def _norm(rows):
    def v(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else float(f"{x:.9g}")
        return x
    return sorted(repr(tuple(v(x) for x in r)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_sql(spark, con, key):
    df = registry.queries()[key](spark, SF)
    res = con.execute(registry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    srows = [tuple(r[c] for c in order) for r in df.collect()]
    drows = [tuple(r[dcols.index(c)] for c in order) for r in res.fetchall()]
    assert _norm(srows) == _norm(drows)


@pytest.mark.parametrize("key", ["group_crosstab", "describe_cat_by_origin", "page_chunks"])
def test_partition_count_independent(spark, key):
    fn = registry.queries()[key]
    out = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(_norm([tuple(r) for r in fn(spark, SF).collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert out[0] == out[1]
