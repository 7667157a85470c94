"""Properties: distributed order statistics equal brute force, loading is
idempotent and order-independent, report invariants hold."""

import os
import random
import statistics
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import order_stats
from ledgerline.functions.order_stats import RankSpec, exact_median, global_rank, stored_median, stored_ranks
from ledgerline.operators import clean, load, reports, validate
from ledgerline.plans import oracle_sql as O
from ledgerline.schemas import TABLES
from ledgerline.sources.testdata import shop_tables
from tests.conftest import SF_SMALL

SETTINGS = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def brute_rank(values, descending=True, nulls_first=True):
    def key(v):
        if v is None:
            return (0 if nulls_first else 1, 0)
        return (1 if nulls_first else 0, -v if descending else v)

    keys = [key(v) for v in values]
    return [1 + sum(1 for k in keys if k < mine) for mine in keys]


@SETTINGS
@given(
    st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=60),
    st.booleans(),
    st.booleans(),
)
def test_global_rank_matches_brute_force(spark, values, descending, nulls_first):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    out = global_rank(df, F.col("v"), "r", descending, nulls_first)
    got = {r["id"]: r["r"] for r in out.collect()}
    want = brute_rank(values, descending, nulls_first)
    assert [got[i] for i in range(len(values))] == want


@SETTINGS
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 50))),
        min_size=1,
        max_size=80,
    ),
)
def test_exact_median_matches_statistics(spark, rows):
    df = spark.createDataFrame(
        [(g, None if v is None else Decimal(v) / 4) for g, v in rows], "g int, v decimal(12,2)"
    )
    got = {r["g"]: r["m"] for r in exact_median(df, ["g"], "v", "m").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        vals = [Decimal(v) / 4 for gg, v in rows if gg == g and v is not None]
        if vals:
            want[g] = statistics.median(vals)
    assert {g: Decimal(m) for g, m in got.items()} == want


def test_hot_key_rank_is_exact(spark):
    # a third of the rows share one key value
    vals = [7] * 300 + list(range(600))
    random.Random(1).shuffle(vals)
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v int")
    got = {r["id"]: r["r"] for r in global_rank(df, F.col("v"), "r").collect()}
    assert [got[i] for i in range(len(vals))] == brute_rank(vals)


def test_rank_and_median_over_many_scales(spark):
    """Values of both signs from 1e-9 to 1e15 that fall into thousands of ranges, with ties."""
    rng = random.Random(5)
    vals = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.randint(-9, 15) for _ in range(700)]
    vals += [0.0] * 20 + vals[:50] + [None] * 5
    df = spark.createDataFrame(list(enumerate(vals)), "id int, v double")
    for descending in (True, False):
        got = {r["id"]: r["r"] for r in global_rank(df, F.col("v"), "r", descending).collect()}
        assert [got[i] for i in range(len(vals))] == brute_rank(vals, descending)
    assert exact_median(df, [], "v", "m").first()["m"] == statistics.median([v for v in vals if v is not None])


def test_ranks_and_medians_run_no_job_while_planning(spark):
    df = spark.range(10).withColumn("v", F.raise_error(F.lit("computed")).cast("double"))
    global_rank(df, F.col("v"), "r")
    exact_median(df, [], "v", "m")


def _typed_orders(t):
    return clean.add_audit_columns(
        load.align_columns(t.orders, TABLES["orders"]).drop("_etl_loaded_at", "_etl_source"),
        "orders",
        "2024-01-01 00:00:00",
    )


def test_incremental_load_idempotent_and_equals_one_shot(spark, tmp_dir):
    t = shop_tables(spark, SF_SMALL)
    orders = _typed_orders(t)
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    a = orders.filter(F.col("created_at") < cut)
    two_step = os.path.join(tmp_dir, "two")
    one_shot = os.path.join(tmp_dir, "one")
    load.load_table(spark, a, "orders", two_step)
    load.load_table(spark, orders, "orders", two_step)
    assert load.load_table(spark, orders, "orders", two_step).rows_inserted == 0
    load.load_table(spark, orders, "orders", one_shot)
    spec = TABLES["orders"]
    x = load.read_target(spark, two_step, spec).drop("_etl_loaded_at")
    y = load.read_target(spark, one_shot, spec).drop("_etl_loaded_at")
    assert x.count() == y.count() == orders.count()
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_cohort_month_0_equals_cohort_size(spark):
    t = shop_tables(spark, SF_SMALL)
    rows = reports.cohort_retention(t.orders).collect()
    assert rows and all(r["month_0"] == r["customers_in_cohort"] for r in rows)


def test_segment_sessions_add_up(spark):
    t = shop_tables(spark, SF_SMALL)
    seg = reports.visitor_segments(t.website_sessions, t.orders, since=O.SINCE)
    total = t.website_sessions.filter(F.col("created_at") >= F.lit(O.SINCE).cast("timestamp_ntz")).count()
    assert sum(r["sessions"] for r in seg.collect()) == total


def test_keep_first_output_keys_unique(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    df = li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("k"), "l_partkey", "l_quantity")
    out = validate.keep_first(df, "k", ["l_partkey", "l_quantity"])
    assert out.count() == out.select("k").distinct().count() == df.select("k").distinct().count()


def test_keep_first_matches_pandas_across_many_splits(spark, tmp_dir):
    """One CSV file read in many splits: keep-first by the file-order key must
    equal pandas' drop_duplicates(keep='first') on the same file."""
    import pandas as pd

    rng = random.Random(7)
    path = os.path.join(tmp_dir, "orders.csv")
    with open(path, "w") as fh:
        fh.write("order_id,created_at,price_usd\n")
        for i in range(20000):
            key = rng.randint(1, 3000)  # many repeats, spread over the whole file
            fh.write(f"{key},2012-01-01 00:00:00,{i}.00\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")  # ~25 splits
    try:
        from ledgerline.sources.csv import read_csv

        raw = read_csv(spark, path, with_order=True)
        assert raw.rdd.getNumPartitions() > 10
        cleaned = clean.clean_dataframe(raw, "orders", "2024-01-01 00:00:00", order_col="_file_order")
        got = {
            r["order_id"]: str(r["price_usd"])
            for r in validate.keep_first(cleaned, "order_id", ["_file_order"]).collect()
        }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    pdf = pd.read_csv(path).drop_duplicates(subset=["order_id"], keep="first")
    want = {int(k): f"{v:.2f}" for k, v in zip(pdf.order_id, pdf.price_usd)}
    assert got == want


def test_order_stats_on_empty_and_all_null_input(spark):
    empty = spark.createDataFrame([], "id int, v double")
    assert global_rank(empty, F.col("v"), "r").collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None)], "id int, v double")
    assert sorted(r["r"] for r in global_rank(nulls, F.col("v"), "r").collect()) == [1, 1]
    assert exact_median(spark.createDataFrame([], "g int, v decimal(12,2)"), ["g"], "v", "m").collect() == []
    whole = spark.createDataFrame([(1, 1.0), (1, 3.0)], "g int, v double")
    assert exact_median(whole, [], "v", "m").first()["m"] == 2.0


def test_stored_ranks_and_medians_on_one_price_level(spark, monkeypatch):
    """A million distinct values within 0.07 % (one cell of the fixed grid), a hot value and NULLs: no range is large."""
    monkeypatch.setattr(order_stats, "RANGE_ROWS", 50_000)
    n = 1_000_000
    close = spark.range(n).select("id", (F.lit(50) + F.pmod(F.col("id") * 7919, F.lit(n)) * F.lit(1e-10)).alias("v"))
    hot = spark.range(n, n + 500_000).select("id", F.lit(50.00005).alias("v"))
    df = close.unionByName(hot).unionByName(spark.range(2_000_000, 2_000_040).select("id", F.lit(None).cast("double").alias("v")))
    distinct = close.select("v").distinct()
    bounds = order_stats.balanced_bounds(distinct, "v", n)
    largest = distinct.groupBy(order_stats.refined_range(F.col("v"), bounds)).count().agg(F.max("count")).first()[0]
    assert len(bounds) == 19 and largest < 1.5 * 50_000
    vals = sorted([r.v for r in close.collect()] + [50.00005] * 500_000)
    assert stored_median(df, [], "v", "m").first().m == statistics.median(vals)
    by_group = {r.g: r.m for r in stored_median(df.withColumn("g", F.col("id") % 3), ["g"], "v", "m").collect()}
    parts = {g: [] for g in range(3)}
    for r in df.where("v is not null").toLocalIterator():
        parts[r.id % 3].append(r.v)
    assert by_group == {g: statistics.median(v) for g, v in parts.items()}
    ranked = stored_ranks(df, [RankSpec(F.col("v"), "r", True, True)])
    import bisect

    got = ranked.where("id % 50021 = 0 or v is null or id = 1200000").collect()
    assert len(got) > 60
    for r in got:
        assert r.r == (1 if r.v is None else 40 + 1 + len(vals) - bisect.bisect_right(vals, r.v))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), max_size=60), st.booleans(), st.booleans(), st.sampled_from([3, 1000]))
def test_stored_ranks_and_medians_match_brute_force(spark, values, descending, nulls_first, range_rows):
    old = order_stats.RANGE_ROWS
    order_stats.RANGE_ROWS = range_rows
    try:
        df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
        got = {r.id: r.r for r in stored_ranks(df, [RankSpec(F.col("v"), "r", descending, nulls_first)]).collect()}
        assert [got[i] for i in range(len(values))] == brute_rank(values, descending, nulls_first)
        known = {g: [v for i, v in enumerate(values) if i % 2 == g and v is not None] for g in range(2)}
        med = {r.g: float(r.m) for r in stored_median(df.withColumn("g", F.col("id") % 2), ["g"], "v", "m").collect()}
        assert med == {g: statistics.median(v) for g, v in known.items() if v}
    finally:
        order_stats.RANGE_ROWS = old


def test_stored_forms_on_a_null_group_and_nothing(spark):
    none = spark.createDataFrame([], "g int, v decimal(12,2)")
    assert stored_ranks(none, [RankSpec(F.col("v"), "r")]).collect() == [] and stored_median(none, [], "v", "m").collect() == []
    df = spark.createDataFrame([(None, Decimal(1)), (None, Decimal(2)), (1, Decimal(5))], "g int, v decimal(12,2)")
    old = order_stats.RANGE_ROWS
    for rows in (1, 100):
        order_stats.RANGE_ROWS = rows
        assert {r.g: float(r.m) for r in stored_median(df, ["g"], "v", "m").collect()} == {None: 1.5, 1: 5.0}
    order_stats.RANGE_ROWS = old


def test_refined_range_counts_bounds_in_few_comparisons(spark):
    """The number of bounds at or below each key, without comparing it with all of them."""
    import bisect
    import re

    longest = lambda c: max(m.count(",") + 1 for m in re.findall(r"array\(([\d., E+-]+)\)", str(c)))
    for n in (1, 2, 3, 16, 17, 255):
        bounds = [float(3 * i) for i in range(n)]
        rows = [r for r in range(-4, 3 * n + 4)]
        df = spark.createDataFrame([(r,) for r in rows] + [(None,)], "v int").select(F.col("v").cast("decimal(12,2)").alias("v"))
        got = df.select("v", order_stats.refined_range(F.col("v"), bounds).alias("r"), order_stats.refined_range(F.col("v"), bounds, False).alias("l")).collect()
        assert {int(x.v): x.r for x in got if x.v is not None} == {r: bisect.bisect_right(bounds, r) for r in rows}
        assert [(x.r, x.l) for x in got if x.v is None] == [(0, n)]
    assert longest(F.array(*[F.lit(b) for b in bounds])) == 255
    assert longest(order_stats.refined_range(F.col("v"), bounds)) <= 16
