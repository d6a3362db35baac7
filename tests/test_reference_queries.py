"""Every registered reference query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from leafmark.plans.binding_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    show = lambda v: "null" if v is None else f"{float(v):.6g}" if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)
    return sorted(columns), sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert canonical(got.columns, got.collect()) == canonical(columns, want.fetchall())


def test_latest_state_and_stream(spark, tmp_path):
    from leafmark.streaming.ledger import append_to, landed, latest_state

    log = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, seq int, s string")
    assert sorted(map(tuple, latest_state(log, "k", ["seq"]).collect())) == [(1, 2, "b"), (2, 1, "c")]
    land, out = str(tmp_path / "land"), str(tmp_path / "out")
    rows = spark.sql("SELECT * FROM VALUES (1L, 'x', timestamp'2024-01-01'), (2L, 'x', timestamp'2024-01-01'), (3L, 'y', timestamp'2024-01-01') AS t(doc_id, text, landed_at)")
    rows.write.parquet(land)
    append_to(landed(spark, land), out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).select("text").distinct().count() == spark.read.parquet(out).count() == 2
