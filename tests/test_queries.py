"""Every core query against its SQL in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import pytest

from papyr.plans import catalogue

DATA = Path(os.environ.get("TEST_DATA", "/root/testdata")) / "sf0.001"
SQL = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(table, names) -> list[tuple]:
    out = []
    for r in table:
        d = dict(zip(names, r, strict=True))
        out.append(tuple(round(float(v), 6) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v) for v in (d[k] for k in sorted(d))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, str(DATA))
    got = [tuple(r) for r in df.collect()]
    if name in SQL:
        cur = duck.execute(SQL[name])
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        assert plain(got, df.columns) == plain(cur.fetchall(), names)
