"""Every named query against its SQL twin on the smallest data set."""

from collections import Counter
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from lodeworks.queries import ORACLES, QUERIES
from lodeworks.queries.roles import GIVEN

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return con


def _rows(frame: pd.DataFrame) -> Counter:
    def text(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "NULL"
        return repr(v.item() if hasattr(v, "item") else v)

    return Counter(tuple(text(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    got = QUERIES[name](spark, DATA).toPandas()
    if name not in ORACLES:
        assert len(got) > 0
        return
    want = duck.execute(ORACLES[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got) == _rows(want)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
