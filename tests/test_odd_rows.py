"""Queries agree with their SQL on rows that the supplied tables do not have."""

import datetime
import os

import numpy as np
import pytest
from conftest import rows_of

from curveloom.plans import catalog, registry  # noqa: F401


def agree(spark, folder, name):
    """Run a query over folder/*.parquet and hold it to its SQL, read by one thread: a table's rows then come in their order."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.execute("SET threads=1")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}/*.parquet'")
    got = registry.QUERIES[name](spark, str(folder))
    cur = con.execute(registry.ORACLES[name])
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    assert rows_of(got.columns, got.collect()) == want
    return want


def test_orders_without_a_date(spark, tmp_path):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    rows = [(1, 7, day(0)), (2, 7, None), (3, 7, day(200)), (4, 7, day(200)), (5, None, None), (6, None, day(3)), (7, 8, None)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    assert len(agree(spark, tmp_path, "order_bands")) == 4


def test_groups_are_not_joined_through_the_driver(spark, small):
    """Files of 5 MB held 1.2 million parts, which filled the driver as broadcasts."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert registry.QUERIES["best_part_per_name_or_brand"](spark, small).count()
    runs = store.executionsList(before, 1000)
    plans = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    assert any("SortMergeJoin" in p for p in plans) and not any("BroadcastExchange" in p for p in plans)


def test_parts_without_a_size_or_brand(spark, tmp_path):
    rows = [(1, "a", "x", "t", None, 5.0), (2, "a", "x", "u", None, 9.0), (3, "a", None, "t", 1, 1.0), (4, "a", None, "t", 1, 2.0), (5, "a", "x", "t", 3, 7.0), (6, "a", "x", "v", 3, None)]
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    assert agree(spark, tmp_path, "best_part_per_name_or_brand") == [(2, 9.0), (3, 1.0), (4, 2.0), (5, 7.0)]


def test_index_of_each_text_in_its_row(spark, tmp_path):
    rows = [(1, "b a b  a c "), (2, ""), (3, None), (4, " "), (5, "x"), (5, "x y x"), (None, "é e é"), (6, " ".join(str(i % 977) for i in range(20_000)))]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    assert len(agree(spark, tmp_path, "inverted_index_round_trip")) == len(rows)
    plan = registry.QUERIES["inverted_index_round_trip"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_daily_means_add_up_in_order(spark, tmp_path):
    """(a + b) + c and a + (b + c) lie on two sides of a half, and b and c in a file of their own."""
    pa = pytest.importorskip("pyarrow")
    from pyarrow import parquet

    rng = np.random.default_rng(5)
    found = []
    while len(found) < 20:
        a, b = (float(v) for v in rng.integers(1, 49_002, 2) / 100)
        c = round(3 * (int(rng.integers(200, 300)) + 0.5) - a - b, 2)
        one, two = np.rint(((a + b) + c) / 3), np.rint((a + (b + c)) / 3)
        if c > 0 and one != two:
            found.append((a, b, c, float(one)))
    first, second = [], []
    for u, (a, b, c, near) in enumerate(found):
        first += [(4 * u, 1, u, a), (4 * u + 1, 2, u, near)]
        second += [(1000 + 4 * u, 1, u, b), (1001 + 4 * u, 1, u, c)]
    (tmp_path / "events.parquet").mkdir()
    for name, rows in (("a", first), ("b", second)):
        at = pa.array([datetime.datetime(2024, 1, d) for _, d, _, _ in rows], pa.timestamp("us"))
        ids, users, values = ([r[i] for r in rows] for i in (0, 2, 3))
        parquet.write_table(pa.table({"event_id": pa.array(ids, pa.int64()), "ts": at, "user_id": pa.array(users, pa.int64()), "value": values}), tmp_path / f"events.parquet/{name}.parquet")
    assert len(agree(spark, tmp_path, "path_quality")) == 20
