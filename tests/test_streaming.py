"""The streaming loader: file landings, restart, replayed micro-batches."""

import os

from pyspark.sql import functions as F

from ledgerline.operators import load
from ledgerline.schemas import TABLES
from ledgerline.streaming.continuous_load import StreamLoad, landing_schema, run_available
from ledgerline.sources.csv import read_csv


def _land(spark, folder, rows):
    df = spark.createDataFrame(rows, "order_id string, created_at string, price_usd string")
    df.coalesce(1).write.mode("append").option("header", True).csv(folder)


def test_stream_landings_restart_and_replay(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    target = os.path.join(tmp_dir, "orders")
    ckpt = os.path.join(tmp_dir, "ckpt")
    _land(spark, landing, [("1", "2012-01-01 00:00:00", "1.00"), ("1", "2012-01-01 00:00:00", "1.00"),
                           ("2", "2012-01-02 00:00:00", "2.00")])
    schema = landing_schema(spark, landing)
    r1 = run_available(spark, landing, "orders", target, "2024-01-01 00:00:00", schema, ckpt)
    assert sum(r.rows_inserted for r in r1) == 2

    # second landing overlaps the first (key 2 again) and adds a late and a new row
    _land(spark, landing, [("2", "2012-01-02 00:00:00", "9.99"), ("3", "2011-12-31 00:00:00", "3.00"),
                           ("4", "2012-02-01 00:00:00", "4.00")])
    r2 = run_available(spark, landing, "orders", target, "2024-01-02 00:00:00", schema, ckpt)
    assert sum(r.rows_inserted for r in r2) == 1  # only key 4: 2 exists, 3 is late

    # restart on the same checkpoint: every file was consumed, nothing is read
    r3 = run_available(spark, landing, "orders", target, "2024-01-03 00:00:00", schema, ckpt)
    assert sum(r.rows_inserted for r in r3) == 0

    got = {r["order_id"]: str(r["price_usd"]) for r in load.read_target(spark, target, TABLES["orders"]).collect()}
    assert got == {1: "1.00", 2: "2.00", 4: "4.00"}

    # a micro-batch delivered twice (at-least-once) does not duplicate rows
    batch = read_csv(spark, landing).withColumn("_landed", F.lit(0)).withColumn("_file", F.lit("x")).withColumn("_block", F.lit(0))
    sink = StreamLoad("orders", target, "2024-01-04 00:00:00", load.target_watermark(spark, target, TABLES["orders"]))
    sink(batch, 99)
    sink(batch, 99)
    assert load.read_target(spark, target, TABLES["orders"]).count() == 3


def test_result_does_not_depend_on_batch_splits(spark, tmp_dir):
    """Files landed out of time order, with a key in two of them: one batch, two or three a run."""
    import time

    landing = os.path.join(tmp_dir, "landing")
    for rows in (
        [("1", "2012-05-01 00:00:00", "1.00")],
        [("2", "2012-01-01 00:00:00", "2.00"), ("1", "2012-05-01 00:00:00", "9.00")],
        [("3", "2012-03-01 00:00:00", "3.00"), ("2", "2012-01-01 00:00:00", "8.00")],
    ):
        _land(spark, landing, rows)
        time.sleep(1.1)  # distinct landing times
    schema = landing_schema(spark, landing)
    results = []
    for n in (None, 1, 2):
        target = os.path.join(tmp_dir, f"orders-{n}")
        run_available(spark, landing, "orders", target, "2024-01-01 00:00:00", schema, os.path.join(tmp_dir, f"ckpt-{n}"), max_files_per_trigger=n)
        results.append(sorted((r["order_id"], str(r["price_usd"])) for r in load.read_target(spark, target, TABLES["orders"]).collect()))
    assert results == [[(1, "1.00"), (2, "2.00"), (3, "3.00")]] * 3
