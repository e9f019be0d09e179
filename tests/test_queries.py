"""Every registered query against its SQL in DuckDB, on the small tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, canonical  # noqa: E402
from packetloom.plans import catalog  # noqa: E402

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, str(SF))
    mine = canonical(df.collect(), df.columns)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert mine
        return
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert mine == canonical(result.fetchall(), columns)


def test_entry(spark):
    assert entry.entry(spark).columns == ["device", "frame_id", "gap_rows", "samples"]


def test_only_known_queries_lack_sql():
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == set()


@pytest.mark.parametrize("name", ["event_time", "key_build", "session_path", "range_scan", "ttl_live", "stored_log_scan"])
def test_session_zone_does_not_matter(spark, db, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        test_query(spark, db, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
