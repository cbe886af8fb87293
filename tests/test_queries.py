"""Every registered query against its SQL, on the smallest tables, and what its plan must not hold."""

import math
import os

import pytest

import __spark_entry__ as entry
from sluice.plans.queries import QUERIES

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the generated tables")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, db, name):
    frame = entry.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    ours = frame.collect()
    cursor = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    assert sorted(frame.columns) == sorted(names)
    assert normal(frame.columns, ours) == normal(names, theirs)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
