"""Every registered query of the library's own operators, against its DuckDB SQL on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

from taxaflow.plans.queries import ORACLE_SQL, QUERIES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(columns).collect()), key=repr)
    answer = duck.execute(ORACLE_SQL[name])
    kinds = {d[0]: str(d[1]) for d in answer.description}
    at = [[d[0] for d in answer.description].index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in answer.fetchall()), key=repr)
    assert {c: KINDS.get(k, kinds[c]) for c, k in df.dtypes} == kinds


def test_the_flagship_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_samples_are_stable(spark):
    a, b = (QUERIES["seeded_sample"](spark, DATA).collect() for _ in range(2))
    assert a == b and len(a) == 100
