"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import os
import sys

import duckdb
import pytest
from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

from pktsieve.plans.queries import REGISTRY  # noqa: E402

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle():
    assert set(NAMES) <= set(E.oracle_sql())
    assert set(NAMES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["pkt_id", "rule_id", "class_id", "egress_port", "outcome"]
    assert df.count() == 1000


SQL_TYPES = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "StringType()": "VARCHAR",
             "DoubleType()": "DOUBLE", "BooleanType()": "BOOLEAN", "DecimalType(38,0)": "DECIMAL(38,0)"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    types = {f.name: SQL_TYPES.get(repr(f.dataType), repr(f.dataType)) for f in df.schema.fields}
    assert types == {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(cols, rows) == digest(ocols, orows)
