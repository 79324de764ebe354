"""Every registered query against its SQL counterpart on the smallest data."""

import importlib
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1] / "tools"))
check = importlib.import_module("check_oracles")
entry = importlib.import_module("__spark_entry__")

from series_lake.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return check.connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(columns)
    assert check.canonical(got.columns, rows) == check.canonical(columns, result.fetchall())
