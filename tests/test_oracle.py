"""Every SQL-checkable key against its DuckDB oracle on the smallest tables."""

import hashlib
import math

import duckdb
import pytest

from cohortkit.plans import catalogue
from tests.conftest import SMOKE

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
SQL = catalogue.oracle_sql()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, bool):
        return int(v)
    if type(v).__name__ == "Decimal":
        return round(float(v), 6)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(SQL))
def test_key_matches_oracle(spark, con, key):
    df = catalogue.queries()[key](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(SQL[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
