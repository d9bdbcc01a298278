"""Every driver query against its SQL in DuckDB, at the smallest scale."""

import glob
import os

import duckdb
import pytest

from loomspark.plans.driver_queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(table, names):
    return sorted(repr([r[n] for n in names]) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, DATA).toArrow()
    if name not in ORACLES:
        assert got.num_rows
        return
    want = db.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    names = sorted(got.column_names)
    assert rows(got, names) == rows(want, names)


def test_hyperevents(spark):
    """Inertia and subset repetition on the worked example of five events."""
    from pyspark.sql import functions as F

    from loomspark.plans import research

    ev = spark.createDataFrame([(1, "p", [1, 2], 1), (2, "p", [1, 3, 4], 2), (3, "p", [2, 3], 3), (4, "a", [1, 2, 3], 4), (5, "b", [1, 2, 3], 5), (6, "q", [2, 3], 6)], "id int, page string, s array<int>, t int")
    assert {r.id: r.repetition for r in research.subset_repetition(ev, "id", "t", "s").collect()} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 1, 6: 3}
    each = research.inertia(ev.select("id", "page", F.explode("s").alias("e"), "t"), ["page", "e"], "t")
    assert {(r.id, r.e): r.inertia for r in each.where("id IN (2, 3)").collect()} == {(2, 1): 1, (2, 3): 0, (2, 4): 0, (3, 2): 1, (3, 3): 1}


def test_matching(spark):
    from loomspark.plans import research

    rows = spark.createDataFrame([(1, 10, 1), (1, 11, 2), (2, 10, 3)], "page int, editor int, n int")
    pool = spark.createDataFrame([(p, e, 0) for p in (1, 2) for e in range(10, 30)], "page int, editor int, n int")
    drawn = research.case_control(rows, pool, "page", "editor", 3)
    assert {(r.page, r.is_case): r["count"] for r in drawn.groupBy("page", "is_case").count().collect()} == {(1, True): 2, (1, False): 6, (2, True): 1, (2, False): 3}
    assert sorted(map(str, drawn.collect())) == sorted(map(str, research.case_control(rows, pool, "page", "editor", 3).collect()))
    at = rows.selectExpr("page", "editor", "date_add(DATE'2020-01-01', n) AS at")
    assert research.core_assortativity(at, "editor", "page", "at").first().pairs == 3
    sessions = rows.selectExpr("page", "editor", "timestamp_seconds(n * 3600) AS at")
    assert {(r.page, tuple(r.editors)) for r in research.hyperevents(sessions, "page", "editor", "at", "2 hours").collect()} == {(1, (10, 11)), (2, (10,))}
