"""Every registered query against its SQL oracle on the smallest driver tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracles import canonical  # noqa: E402
from chorale.plans.catalog import QUERIES  # noqa: E402
from chorale.plans.oracle import ORACLES  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables are absent")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_oracle(spark, db, name):
    frame = queries()[name](spark, str(SF_DIR))
    mine = [tuple(r) for r in frame.collect()]
    result = db.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert canonical(frame.columns, mine) == canonical(names, result.fetchall())
    assert mine


def test_names_agree():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLES) == {"workflow_predictions"}


def test_entry(spark):
    assert entry(spark).count() > 0
