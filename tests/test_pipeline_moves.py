"""What the end-to-end load moves and writes: full rows stay where they were decoded and are written once."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from ledgerline.operators import load
from ledgerline.plans import checks, pipeline
from ledgerline.schemas import TABLES
from ledgerline.sources.csv import read_csv
from ledgerline.sources.testdata import ShopTables


def _orders_csv(path, rows):
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as fh:
        fh.write("order_id,created_at,price_usd\n")
        fh.writelines(f"{k},2012-01-01 00:00:00,{p}.00\n" for k, p in rows)


def _many_rows():
    """Over two bitmaps of positions; repeated keys, exact copies, keys missing or not numeric."""
    rows = [("x" if i % 997 == 0 else "" if i % 101 == 0 else i % 60_000, i) for i in range(90_000)]
    return [r for i, r in enumerate(rows) for _ in range(2 if i % 7 == 0 else 1)]


@pytest.mark.parametrize("broadcast", [pipeline.MAX_BROADCAST_BITMAPS, 0])
def test_winners_by_bitmap(spark, tmp_dir, monkeypatch, broadcast):
    rows = _many_rows()
    src, out = os.path.join(tmp_dir, "orders.csv"), os.path.join(tmp_dir, "staged")
    _orders_csv(src, rows)
    monkeypatch.setattr(pipeline, "MAX_BROADCAST_BITMAPS", broadcast)
    counts = pipeline.stage_clean_table(spark, read_csv(spark, src, with_order=True), "orders", out, "2024-01-01 00:00:00")
    first = {}
    for k, p in rows:
        if k not in ("", "x"):
            first.setdefault(k, p)
    got = spark.read.parquet(out)
    assert {r.order_id: int(r.price_usd) for r in got.collect()} == first and got.count() == len(first)
    different = set(rows)
    assert (counts.rows_in, counts.exact_duplicates) == (len(rows), len(rows) - len(different))
    assert (counts.null_keys, counts.bad_keys) == tuple(sum(k == no for k, _ in different) for no in ("", "x"))
    assert counts.rows_clean == sum(k not in ("", "x") for k, _ in different)
    assert counts.duplicate_pks == counts.rows_clean - len(first)


def test_full_rows_are_not_shuffled(spark, tmp_dir):
    src = os.path.join(tmp_dir, "orders.csv")
    _orders_csv(src, [(i % 50, i) for i in range(200)])
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")  # as with many winners
        with pipeline.clean_rows(spark, read_csv(spark, src, with_order=True), "orders", os.path.join(tmp_dir, "s"), "2024-01-01 00:00:00") as (_, new, rows):
            assert new == rows.count() == 50
            plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert "SortMergeJoin" not in plan and not any("price_usd" in x or "_at#" in x for x in moved)


def test_a_first_load_writes_full_rows_twice_only(spark, tmp_dir, monkeypatch):
    """The stored decode and the target; no staged copy between."""
    src = os.path.join(tmp_dir, "src")
    _orders_csv(os.path.join(src, "orders.csv"), [(1, 1), (1, 2), (2, 3)])
    written, real = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        real(self, path, *args, **kw)
        if "price_usd" in spark.read.parquet(path).columns:
            written.append(path)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    run = pipeline.run_pipeline(spark, src, os.path.join(tmp_dir, "t"), tables=["orders"]).first()
    assert (run["status"], run["rows_inserted"]) == ("loaded", 2)
    assert len(written) == 2 and written[0].endswith(".__decoded")
    again = pipeline.run_pipeline(spark, src, os.path.join(tmp_dir, "t"), tables=["orders"]).first()
    assert (again["status"], again["rows_inserted"]) == ("nothing new", 0)


@pytest.mark.parametrize("table", ["orders", "products"])
def test_a_first_load_of_another_number_of_rows_stays_invisible(spark, tmp_dir, table):
    spec, target = TABLES[table], os.path.join(tmp_dir, table)
    df = spark.range(3).select(F.col("id").alias(spec.pk), F.lit("2012-01-01 00:00:00").cast("timestamp_ntz").alias("created_at"))
    with pytest.raises(RuntimeError, match="3 rows staged of 4"):
        load.load_table(spark, df, table, target, unique_keys=True, expected=4)
    assert load.read_target(spark, target, spec) is None
    assert load.load_table(spark, df, table, target, unique_keys=True, expected=3).rows_inserted == 3
    assert load.read_target(spark, target, spec).count() == 3


def _copied_tables(spark, folder):
    """Orders whose key repeats or is missing, lines without an order."""
    time = "timestamp_ntz '1996-01-0{} 00:00:00'"
    orders = ", ".join(f"({k}, 1L, 'F', 10.5D, {time.format(d)}, '1-URGENT')" for k, d in (("1L", 1), ("2L", 2), ("2L", 3), ("CAST(NULL AS BIGINT)", 4)))
    spark.sql(f"SELECT * FROM VALUES {orders} AS o(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)").write.parquet(f"{folder}/orders.parquet")
    lines = ", ".join(f"({k}, {p}L, 1L, {n}, 1D, 9.25D, 0.1D, 'R', {time.format(5)})" for k, p, n in (("1L", 3, 2), ("1L", 4, 1), ("2L", 5, 1), ("7L", 6, 1), ("CAST(NULL AS BIGINT)", 7, 1)))
    columns = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_shipdate"
    spark.sql(f"SELECT * FROM VALUES {lines} AS l({columns})").write.parquet(f"{folder}/lineitem.parquet")


def test_stored_lines_give_the_same_tables(spark, tmp_dir):
    _copied_tables(spark, tmp_dir)
    plain, stored = ShopTables(spark, tmp_dir), ShopTables(spark, tmp_dir)
    stored.store_lines()
    for name in ("orders", "order_items", "order_item_refunds"):
        a, b = plain.table(name), stored.table(name)
        assert a.dtypes == b.dtypes and a.count() == b.count() == 4, name
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name
    assert "Window" not in stored.order_items._jdf.queryExecution().executedPlan().toString()


def test_landing_files_are_compressed(spark):
    folder = checks._export_dirty_csv(ShopTables(spark, "/root/testdata/sf0.001"))
    parts = glob.glob(f"{folder.removeprefix('file:')}/*.csv/part-*")
    assert parts and all(p.endswith(".csv.gz") for p in parts)


def test_narrow_rows_end_with_what_differs(spark, tmp_dir, monkeypatch):
    """Values that are alike in most rows lie together in a shuffled row, so it compresses."""
    from pyspark.sql.classic.dataframe import DataFrame

    src, seen = os.path.join(tmp_dir, "orders.csv"), []
    _orders_csv(src, [(k, k) for k in range(10)])
    before = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, *a: (seen.append((self.columns, a)), before(self, *a))[1])
    pipeline.stage_clean_table(spark, read_csv(spark, src, with_order=True), "orders", os.path.join(tmp_dir, "staged"), "2024-01-01 00:00:00")
    assert (["_h2", "_marks", "_key", "_h1", "_at"], ("_key",)) in seen
