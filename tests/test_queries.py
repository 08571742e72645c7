import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from arraymetrics.operators import reports
from arraymetrics.plans import adapters, queries

SF = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


def _rows(frame, columns):
    def plain(v):
        return None if v is None or v != v else round(float(v), 8) if isinstance(v, float) else str(v)

    return sorted((tuple(plain(v) for v in row) for row in frame[columns].astype(object).values.tolist()), key=str)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    got, want = queries.QUERIES[name](spark, str(SF)).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert _rows(got, columns) == _rows(want, columns)


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_suggestions(spark):
    assert [(r.metric, r.suggestion) for r in queries.QUERIES["c07_suggest"](spark, str(SF)).collect()] == [("read_bandwidth_mbs", "read_bandwidth_mb_s")]


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
def test_plans(spark):
    plan = lambda n: queries.QUERIES[n](spark, str(SF))._jdf.queryExecution().executedPlan().toString()
    kpis = reports.kpi_points(adapters.points(spark, str(SF)))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in kpis and "BroadcastHashJoin" in kpis
    assert "TakeOrderedAndProject" in plan("g01_top_loaded")
    assert "props" not in plan("d04_stats")
