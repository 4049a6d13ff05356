"""Every query of the library's own against its SQL in DuckDB, on the smallest tables."""

import math
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from tidemark import queries as own

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 5)
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    return tuple(map(plain, x)) if isinstance(x, (list, tuple)) else x


def same(frame, sql, data=DATA):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(frame.columns)
    mine = sorted(repr(plain(tuple(r[n] for n in sorted(names)))) for r in frame.collect())
    theirs = sorted(repr(plain(tuple(r[names.index(n)] for n in sorted(names)))) for r in result.fetchall())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(own.QUERIES))
def test_query(spark, name):
    frame = own.QUERIES[name](spark, DATA)
    if name in own.ORACLES:
        same(frame, own.ORACLES[name])
    else:
        assert frame.count() > 0  # test_operators.py has what they are to return
