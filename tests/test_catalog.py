"""Every registered query against its SQL on the smallest data, and checks of the physical plans."""

import duckdb
import pytest

from check import TABLES, rows_of
from kinweave.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    q = QUERIES[name]
    df = q.run(spark, FOLDER)
    got, columns = rows_of(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if q.sql is not None:
        rel = con.execute(q.sql)
        want, names = rows_of([d[0] for d in rel.description], rel.fetchall())
        assert columns == names
        assert got == want


def test_every_operator_has_a_query():
    covered = {o for q in QUERIES.values() for o in q.operators.split()}
    sections = {"S": 14, "V": 24, "Q": 8, "I": 26, "M": 11, "E": 14, "K": 13, "R": 20, "X": 8}
    wanted = {f"O-{s}{i}" for s, n in sections.items() for i in range(1, n + 1)} | {f"O-T{i}" for i in (1, 2, 3, 5, 6, 7, 8)}
    assert wanted <= covered, sorted(wanted - covered)
