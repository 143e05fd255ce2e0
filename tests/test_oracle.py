"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import TABLES, verdict  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the check tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, con, name):
    got = contract.queries()[name](spark, SF_DIR).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    ok, why = verdict(got, con.execute(SQL[name]).df())
    assert ok, why


def test_entry(spark):
    assert contract.entry(spark).columns == ["user_id", "item_id", "raw_score", "pseudo_rating"]
