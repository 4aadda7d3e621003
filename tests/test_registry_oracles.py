"""Every registered query against its DuckDB oracle on the smallest scale
(the driver's gate runs the same comparison at sf0.01)."""

import importlib
import os

import duckdb
import pytest

from conftest import SF_SMALL

ENTRY = importlib.import_module("__spark_entry__")
NAMES = sorted(ENTRY.queries())
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = ENTRY.queries()[name](spark, SF_SMALL)
    rows = sdf.collect()
    sql = ENTRY.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle (rows-only)")
    ocols = [d[0] for d in duck.execute(f"DESCRIBE {sql}").fetchall()]
    otypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert sorted(sdf.columns) == sorted(ocols)
    for f in sdf.schema.fields:
        assert SPARK_TO_DUCK.get(f.dataType.simpleString()) == otypes[f.name], f.name
    order = sorted(sdf.columns)
    got = sorted("|".join(_canon(r[c]) for c in order) for r in rows)
    res = duck.execute(f"SELECT {', '.join(order)} FROM ({sql})").fetchall()
    want = sorted("|".join(_canon(v) for v in r) for r in res)
    assert len(got) == len(want)
    assert got == want
