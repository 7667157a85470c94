"""Cleaning, CSV scan, validation and loading on hand-written edge cases."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean, load, validate
from ledgerline.plans.pipeline import read_loaded, run_pipeline
from ledgerline.schemas import TABLES
from ledgerline.sources.csv import read_csv
from tests.fixtures import frame, order, ts


def _write(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def test_csv_scan_headers_na_tokens_and_bad_bytes(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    _write(
        p,
        b"Order ID, Created At ,Price USD,Utm Source\n"
        b"1,2012-03-19 08:04:16,49.99,NULL\n"
        b"2,bad,nan,\n"
        b"3,2012-03-19,1e3,caf\xff\n",
    )
    df = clean.normalize_columns(read_csv(spark, p))
    assert df.columns == ["order_id", "created_at", "price_usd", "utm_source"]
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["1"]["utm_source"] is None  # 'NULL' token
    assert rows["2"]["price_usd"] is None and rows["2"]["utm_source"] is None
    assert rows["3"]["utm_source"] == "caf�"  # undecodable byte -> U+FFFD


def test_header_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        clean.normalize_columns(df)


def test_casts_and_strip(spark):
    df = spark.createDataFrame(
        [
            ("bad", "abc", "  a\t"),
            ("2012-03-19 08:04:16", "1e3", " b "),
            ("3/19/2012 8:04", "49.995", "   "),
            ("2012-03-19", "12345678901", None),
        ],
        "created_at string, price_usd string, utm_source string",
    )
    out = clean.strip_text_columns(clean.cast_numeric(clean.cast_timestamps(df))).collect()
    assert out[0]["created_at"] is None and out[0]["price_usd"] is None
    assert out[0]["utm_source"] == "a"  # tab stripped (trim() would keep it)
    assert out[1]["created_at"] == ts("2012-03-19 08:04:16") and str(out[1]["price_usd"]) == "1000.00"
    assert out[1]["utm_source"] == "b"
    assert out[2]["created_at"] == ts("2012-03-19 08:04:00") and str(out[2]["price_usd"]) == "50.00"
    assert out[2]["utm_source"] == ""  # whitespace-only -> empty string, not NULL
    assert out[3]["created_at"] == ts("2012-03-19 00:00:00") and out[3]["price_usd"] is None


def test_dedup_keeps_near_duplicates(spark):
    df = spark.createDataFrame(
        [("1", None, "x"), ("1", None, "x"), ("1", None, "x "), ("2", "a", None)],
        "order_id string, a string, b string",
    )
    assert clean.drop_duplicate_rows(df).count() == 3


def test_clean_dataframe_drops_null_pk_and_adds_audit(spark):
    df = spark.createDataFrame(
        [(None, "2012-01-01 00:00:00"), ("7", "2012-01-01 00:00:00"), ("x", "2012-01-01")],
        "`Order Id` string, `Created At` string",
    )
    out = clean.clean_dataframe(df, "orders", "2024-01-01 00:00:00").collect()
    assert [r["order_id"] for r in out] == [7]  # NULL and unparseable keys dropped
    assert out[0]["_etl_source"] == "orders" and out[0]["_etl_loaded_at"] == ts("2024-01-01 00:00:00")


def test_validation_report_and_keep_first(spark):
    rows = [
        order(1, "2012-01-01 00:00:00", price=1),
        order(1, "2012-01-02 00:00:00", price=2),
        order(2, "2012-01-03 00:00:00", price=3),
    ]
    df = frame(spark, "orders", rows)
    r = validate.validation_report(df, "orders").first()
    assert (r["row_count"], r["null_pk_count"], r["duplicate_pk_count"], r["passed"]) == (3, 0, 1, True)
    v = validate.validate(df, "orders", order_by=["created_at"])
    kept = {x["order_id"]: x["price_usd"] for x in v.frame.collect()}
    assert kept == {1: 1, 2: 3}
    assert not validate.validate(df, "orders", on_duplicate="fail").passed
    empty = frame(spark, "orders", [])
    assert not validate.validate(empty, "orders").passed
    no_pk = df.drop("order_id")
    assert validate.validate(no_pk, "orders").message.startswith("primary key")


def test_keep_first_follows_csv_file_order(spark, tmp_dir):
    p = os.path.join(tmp_dir, "orders.csv")
    lines = ["order_id,created_at,price_usd"]
    lines += [f"{i},2012-01-01 00:00:00,{i}.00" for i in range(1, 2001)]
    lines += ["5,2012-01-01 00:00:00,999.00"]  # same key, later in the file
    _write(p, ("\n".join(lines) + "\n").encode())
    raw = read_csv(spark, p, with_order=True)
    cleaned = clean.clean_dataframe(raw, "orders", "2024-01-01 00:00:00", order_col="_file_order")
    kept = validate.keep_first(cleaned, "order_id", ["_file_order"]).filter("order_id = 5")
    assert [str(r["price_usd"]) for r in kept.collect()] == ["5.00"]


def _orders_df(spark, rows, run_ts="2024-01-01 00:00:00"):
    return clean.add_audit_columns(frame(spark, "orders", rows), "orders", run_ts)


def test_watermark_strict_ties_late_and_null_rows(spark, tmp_dir):
    target = os.path.join(tmp_dir, "orders")
    first = _orders_df(spark, [order(1, "2012-01-01 10:00:00"), order(2, None)])
    r1 = load.load_table(spark, first, "orders", target)
    assert r1.rows_inserted == 2 and r1.watermark is None  # NULL created_at kept on first load
    second = _orders_df(
        spark,
        [
            order(3, "2012-01-01 10:00:00"),  # equal to the watermark: dropped (strict)
            order(4, "2011-12-31 00:00:00"),  # late: dropped
            order(5, None),  # NULL created_at: dropped once a watermark exists
            order(1, "2012-02-01 00:00:00"),  # existing key, newer: skipped by insert-if-absent
            order(6, "2012-01-01 10:00:01"),
        ],
    )
    r2 = load.load_table(spark, second, "orders", target)
    assert r2.watermark == "2012-01-01 10:00:00" and r2.rows_inserted == 1
    ids = sorted(r["order_id"] for r in load.read_target(spark, target, TABLES["orders"]).collect())
    assert ids == [1, 2, 6]
    assert load.load_table(spark, second, "orders", target).rows_inserted == 0  # idempotent
    # opt-in: a lateness allowance re-reads the tied row; the key anti-join
    # keeps the rows already loaded from being inserted twice
    late = load.load_table(spark, second, "orders", target, inclusive=True, lateness="1 second")
    assert late.rows_inserted == 1  # order 3 (10:00:00 >= 10:00:01 - 1 s)


def test_watermark_independent_of_session_zone(spark, tmp_dir):
    target = os.path.join(tmp_dir, "orders")
    load.load_table(spark, _orders_df(spark, [order(1, "2012-06-01 00:00:00")]), "orders", target)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        r = load.load_table(
            spark, _orders_df(spark, [order(2, "2012-06-01 00:00:01")]), "orders", target
        )
        assert r.watermark == "2012-06-01 00:00:00" and r.rows_inserted == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_full_refresh_replaces_snapshot(spark, tmp_dir):
    target = os.path.join(tmp_dir, "products")
    p1 = clean.add_audit_columns(
        frame(spark, "products", [{"product_id": 1, "product_name": "a"}]), "products", "2024-01-01 00:00:00"
    )
    p2 = clean.add_audit_columns(
        frame(spark, "products", [{"product_id": 2, "product_name": "b"}]), "products", "2024-01-02 00:00:00"
    )
    load.load_table(spark, p1, "products", target)
    r = load.load_table(spark, p2, "products", target)
    assert r.strategy == "full_refresh" and r.rows_inserted == 1
    assert [x["product_id"] for x in load.read_target(spark, target, TABLES["products"]).collect()] == [2]


def test_pipeline_missing_file_and_bad_table_do_not_stop_others(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(
        os.path.join(src, "orders.csv"),
        b"order_id,created_at,price_usd\n1,2012-01-01 00:00:00,1.00\n1,2012-01-01 00:00:00,1.00\n"
        b"2,2012-01-02 00:00:00,2.00\n2,2012-01-03 00:00:00,3.00\n",
    )
    _write(os.path.join(src, "products.csv"), b"name\nx\n")  # key column missing
    target = os.path.join(tmp_dir, "target")
    summary = {r["table_name"]: r for r in run_pipeline(spark, src, target, run_ts="2024-01-01 00:00:00").collect()}
    assert summary["orders"]["status"] == "loaded" and summary["orders"]["rows_inserted"] == 2
    # an exact copy of key 1, and a second row for key 2
    o = summary["orders"]
    assert (o["rows_in"], o["exact_duplicates"], o["rows_clean"], o["duplicate_pks"]) == (4, 1, 3, 1)
    assert summary["products"]["status"] == "failed"
    assert summary["website_sessions"]["message"] == "file not found"
    loaded = read_loaded(spark, target)
    got = {r["order_id"]: str(r["price_usd"]) for r in loaded["orders"].collect()}
    assert got == {1: "1.00", 2: "2.00"}  # duplicate key: first in file order
    again = {r["table_name"]: r for r in run_pipeline(spark, src, target).collect()}
    assert again["orders"]["rows_inserted"] == 0 and again["orders"]["status"] == "nothing new"


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5)], "id int, v double")
    assert [r["v"] for r in load.nan_to_null(df).orderBy("id").collect()] == [None, 1.5]
    assert load.nan_to_null(df).filter(F.col("v").isNull()).count() == 1


def test_stored_watermark_tracks_appends(spark, tmp_dir):
    target = os.path.join(tmp_dir, "orders")
    load.load_table(spark, _orders_df(spark, [order(1, "2012-01-01 10:00:00")]), "orders", target)
    assert load.stored_watermark(spark, target) == (True, "2012-01-01 10:00:00")
    load.load_table(
        spark,
        _orders_df(spark, [order(2, "2012-03-01 00:00:00.5"), order(3, "2012-02-01 00:00:00")]),
        "orders",
        target,
    )
    found, wm = load.stored_watermark(spark, target)
    assert found and wm.startswith("2012-03-01 00:00:00.5")
    # the stored mark equals a scan of the target, and the target reader ignores it
    assert wm == load.watermark_value(load.read_target(spark, target, TABLES["orders"]))
    assert load.read_target(spark, target, TABLES["orders"]).count() == 3


def test_command_line_load_and_verify(spark, tmp_dir, capsys):
    from ledgerline.__main__ import main

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(
        os.path.join(src, "orders.csv"),
        b"order_id,created_at,website_session_id,price_usd\n1,2012-04-02 00:00:00,10,5.00\n",
    )
    _write(
        os.path.join(src, "website_sessions.csv"),
        b"website_session_id,created_at,device_type\n10,2012-04-01 00:00:00,mobile\n11,2012-04-03 00:00:00,desktop\n",
    )
    wh = os.path.join(tmp_dir, "wh")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:  # the command line reuses this session (getOrCreate) and sets its own partitions
        assert main(["--shuffle-partitions", "4", "load", src, wh]) == 1  # four tables have no file
        assert main(["--shuffle-partitions", "4", "verify", wh]) == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    out = capsys.readouterr().out
    assert "website_sessions" in out and "50.0" in out  # 1 order / 2 sessions in April 2012


def _csv(path, rows):
    import csv

    with open(path, "w", newline="", encoding="utf-8") as fh:
        csv.writer(fh).writerows(rows)


def test_standard_csv_quoting(spark, tmp_dir):
    """Files as Python's csv module writes them: doubled quotes, commas, backslashes, newlines."""
    p = os.path.join(tmp_dir, "q.csv")
    values = ['He said "hi", ok', "line1\nline2", "ends with \\", '\\"', '""', " pad ", "a,b,c"]
    _csv(p, [["id", "v", "w"], *[[str(i), v, "x"] for i, v in enumerate(values)]])
    got = {r["id"]: (r["v"], r["w"]) for r in read_csv(spark, p, multiline=True).collect()}
    assert got == {str(i): (v, "x") for i, v in enumerate(values)}


def test_malformed_rows_fail_or_are_counted(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(
        os.path.join(src, "orders.csv"),
        b"order_id,created_at,price_usd\n1,2012-01-01 00:00:00,1.00\n2,2012-01-02 00:00:00,2.00,surplus\n3,2012-01-03 00:00:00\n4,2012-01-04 00:00:00,,\n",
    )
    run = lambda name, **kw: {r["table_name"]: r for r in run_pipeline(spark, src, os.path.join(tmp_dir, name), tables=["orders"], **kw).collect()}["orders"]
    failed = run("a")
    assert failed["status"] == "failed" and "malformed CSV row" in failed["message"]
    counted = run("b", malformed="count")
    assert (counted["status"], counted["malformed_rows"], counted["rows_in"], counted["rows_inserted"]) == ("loaded", 1, 3, 3)
    with pytest.raises(Exception, match="malformed"):
        read_csv(spark, os.path.join(src, "orders.csv")).select("order_id").collect()


def test_lost_values_are_counted_and_can_fail(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(
        os.path.join(src, "orders.csv"),
        b"order_id,created_at,price_usd\nX7,2012-01-01 00:00:00,1\n,2012-01-01 00:00:00,1\n1,2012-01-01 00:00:00,99999999999\n2,soon,5\n2,soon,5\n",
    )
    r = run_pipeline(spark, src, os.path.join(tmp_dir, "keep"), tables=["orders"]).first()
    counts = {k: r[k] for k in ("rows_in", "exact_duplicates", "bad_dates", "bad_money", "null_keys", "bad_keys", "rows_clean", "duplicate_pks", "rows_inserted")}
    assert counts == dict(rows_in=5, exact_duplicates=1, bad_dates=1, bad_money=1, null_keys=1, bad_keys=1, rows_clean=2, duplicate_pks=0, rows_inserted=2)
    r = run_pipeline(spark, src, os.path.join(tmp_dir, "fail"), tables=["orders"], on_bad_value="fail").first()
    assert r["status"] == "failed" and "1 bad keys, 1 bad money" in r["message"]


def test_failure_message_is_whole(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    surplus = "s" * 3000
    _write(os.path.join(src, "orders.csv"), f"order_id,created_at\n1,2012-01-01 00:00:00,{surplus}\n".encode())
    assert surplus in run_pipeline(spark, src, os.path.join(tmp_dir, "t"), tables=["orders"]).first()["message"]


def test_batch_with_repeated_keys_loads_each_once(spark, tmp_dir):
    target = os.path.join(tmp_dir, "orders")
    rows = [order(1, "2012-01-01 00:00:00", price=5), order(1, "2012-01-01 00:00:00", price=2), order(2, "2012-01-02 00:00:00", price=1)]
    assert load.load_table(spark, _orders_df(spark, rows), "orders", target).rows_inserted == 2
    assert load.load_table(spark, _orders_df(spark, [order(9, "2013-01-01 00:00:00", price=5)] * 3), "orders", target).rows_inserted == 1
    got = sorted((r["order_id"], int(r["price_usd"])) for r in load.read_target(spark, target, TABLES["orders"]).collect())
    assert got == [(1, 2), (2, 1), (9, 5)]


def test_file_system_errors_fail_the_load(spark, tmp_dir, monkeypatch):
    target = os.path.join(tmp_dir, "orders")
    df = _orders_df(spark, [order(1, "2012-01-01 00:00:00", price=5)])
    load.load_table(spark, df, "orders", target)

    def broken(*_):
        raise OSError("name node is down")

    monkeypatch.setattr(load, "path_exists", broken)
    with pytest.raises(OSError):
        load.load_table(spark, df, "orders", target)
    monkeypatch.undo()
    assert load.read_target(spark, target, TABLES["orders"]).count() == 1


def _products(spark, n, name):
    rows = frame(spark, "products", [{"product_id": i, "product_name": name} for i in range(1, n + 1)])
    return clean.add_audit_columns(rows, "products", "2024-01-01 00:00:00")


def _names(spark, target):
    df = load.read_target(spark, target, TABLES["products"])
    return None if df is None else sorted(r["product_name"] for r in df.collect())


class _Watched:
    """A file system whose every call is framed by a look at the target."""

    def __init__(self, fs, look):
        self._fs, self._look = fs, look

    def __getattr__(self, name):
        call = getattr(self._fs, name)

        def run(*args):
            self._look()
            try:
                return call(*args)
            finally:
                self._look()

        return run


def test_reader_at_every_file_system_call_of_a_refresh(spark, tmp_dir, monkeypatch):
    from ledgerline.sources import files

    target = os.path.join(tmp_dir, "products")
    real, looking, seen = files._fs, [], []

    def look():
        if not looking:  # the reader's own calls are not watched
            looking.append(1)
            seen.append(_names(spark, target))
            looking.clear()

    monkeypatch.setattr(files, "_fs", lambda s, p: (lambda fs, path, jvm: (_Watched(fs, look), path, jvm))(*real(s, p)))
    versions = [["a"] * 2, ["b"] * 3, ["c"], ["d"] * 2]
    before = None
    for rows in versions:
        seen.clear()
        load.load_table(spark, _products(spark, len(rows), rows[0]), "products", target)
        assert len(seen) > 10 and all(x in (before, rows) for x in seen)
        # old rows first, then the new ones for good
        assert [x == rows for x in seen] == sorted(x == rows for x in seen) and seen[-1] == rows
        before = rows
    assert len(os.listdir(os.path.join(target, "_snapshots"))) == 2


@pytest.mark.parametrize("crash", ["writing", "written", "staged entry", "published"])
def test_refresh_killed_at_any_point(spark, tmp_dir, crash):
    """The folders that a kill leaves: readers see the last published rows, the next refresh tidies up."""
    from ledgerline.sources import files

    target = os.path.join(tmp_dir, "products")
    load.load_table(spark, _products(spark, 1, "a"), "products", target)
    snapshot = files.write_snapshot(_products(spark, 1, "b"), target)
    if crash == "writing":
        os.remove(os.path.join(snapshot, "_SUCCESS"))
        with pytest.raises(OSError):
            files.publish_snapshot(spark, target, snapshot)
    if crash == "staged entry":
        _write(os.path.join(target, "_commits", ".entry-0"), snapshot.rsplit("/", 1)[1][:3].encode())
    if crash == "published":
        files.add_line(spark, f"{target}/_commits", snapshot.rsplit("/", 1)[1])
    assert _names(spark, target) == (["b"] if crash == "published" else ["a"])
    load.load_table(spark, _products(spark, 1, "c"), "products", target)
    assert _names(spark, target) == ["c"]
    left = os.listdir(os.path.join(target, "_snapshots"))
    assert len(left) == 2 and (os.path.basename(snapshot) in left) == (crash == "published")


def test_failed_refresh_keeps_the_rows(spark, tmp_dir):
    target = os.path.join(tmp_dir, "products")
    load.load_table(spark, _products(spark, 1, "a"), "products", target)
    bad = _products(spark, 2, "b").withColumn("product_name", F.when(F.col("product_id") > 1, F.raise_error(F.lit("disk full"))).otherwise("b"))
    with pytest.raises(Exception, match="disk full"):
        load.load_table(spark, bad, "products", target)
    assert _names(spark, target) == ["a"] and len(os.listdir(os.path.join(target, "_snapshots"))) == 1


def test_refresh_over_a_plain_folder(spark, tmp_dir):
    """A target written before targets had versions is read as it is, then replaced."""
    target = os.path.join(tmp_dir, "products")
    _products(spark, 2, "old").write.parquet(target)
    assert _names(spark, target) == ["old"] * 2
    for name in ("new", "newer"):
        load.load_table(spark, _products(spark, 1, name), "products", target)
        assert _names(spark, target) == [name]
    assert [n for n in os.listdir(target) if n.startswith("part-")] == []


def test_state_lines_survive_readers_and_old_files(spark, tmp_dir):
    from ledgerline.sources import files

    path = os.path.join(tmp_dir, "mark")
    assert files.read_line(spark, path) is None
    _write(path, b"plain")
    assert files.read_line(spark, path) == "plain"
    for i in range(20):
        files.write_line(spark, path, f"line {i}")
        assert files.read_line(spark, path) == f"line {i}"
    files.write_line(spark, path, "")
    assert files.read_line(spark, path) == ""
    files.delete_line(spark, path)
    assert files.read_line(spark, path) is None


def test_mart_that_cannot_be_written_keeps_its_rows(spark, tmp_dir, monkeypatch):
    from ledgerline.plans import marts

    versions = {"a": 1, "b": 1}
    monkeypatch.setattr(marts, "register_views", lambda v: None)
    monkeypatch.setattr(marts, "stage_all", lambda r: r)
    built = lambda *_: {n: spark.createDataFrame([(v,)], "v int") for n, v in versions.items()}
    monkeypatch.setattr(marts, "build_marts", built)
    paths = marts.materialize(spark, {}, tmp_dir)
    assert {n: spark.read.parquet(p).first().v for n, p in paths.items()} == versions
    versions["a"] = 2
    monkeypatch.setattr(marts, "build_marts", lambda *_: built() | {"b": spark.range(1).select(F.raise_error(F.lit("broken")).alias("v"))})
    with pytest.raises(Exception, match="broken"):
        marts.materialize(spark, {}, tmp_dir)
    assert [marts.read_mart(spark, tmp_dir, n).first().v for n in "ab"] == [1, 1]
    monkeypatch.setattr(marts, "build_marts", built)
    marts.materialize(spark, {}, tmp_dir)
    assert [marts.read_mart(spark, tmp_dir, n).first().v for n in "ab"] == [2, 1]


def test_row_identity_does_not_depend_on_splits(spark, tmp_dir, monkeypatch):
    """Other split sizes between the decision and the copy of the winners; several files, repeated keys and rows."""
    from ledgerline.plans import pipeline

    src = os.path.join(tmp_dir, "orders.csv")
    os.makedirs(src)
    want, seen = {}, set()
    for part in range(3):
        lines = ["order_id,created_at,price_usd"]
        for i in range(400):
            key = (i * 7 + part * 50) % 900
            line = f"{key},2012-01-01 00:00:00,{part * 400 + i}.00"
            lines += [line, line] if i % 5 == 0 else [line]
            want.setdefault(key, f"{part * 400 + i}.00")
            seen.add(line)
        _write(os.path.join(src, f"part-{part}.csv"), ("\n".join(lines) + "\n").encode())
    real, old = pipeline._store_decoded, spark.conf.get("spark.sql.files.maxPartitionBytes")

    def store(*args):
        out = real(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        return out

    monkeypatch.setattr(pipeline, "_store_decoded", store)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
        raw = read_csv(spark, src, with_order=True)
        out = os.path.join(tmp_dir, "staged")
        counts = pipeline.stage_clean_table(spark, raw, "orders", out, "2024-01-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert counts.exact_duplicates == 3 * 80 and counts.rows_clean == len(seen) and counts.duplicate_pks == len(seen) - len(want)
    assert {r.order_id: str(r.price_usd) for r in spark.read.parquet(out).collect()} == want


def test_too_few_staged_rows_fail_the_table(spark, tmp_dir, monkeypatch):
    from ledgerline.plans import pipeline

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    _write(os.path.join(src, "orders.csv"), b"order_id,created_at\n1,2012-01-01 00:00:00\n2,2012-01-02 00:00:00\n")
    real = pipeline.add_audit_columns
    monkeypatch.setattr(pipeline, "add_audit_columns", lambda df, *a: real(df.limit(1), *a))
    r = run_pipeline(spark, src, os.path.join(tmp_dir, "t"), tables=["orders"]).first()
    assert r["status"] == "failed" and "1 rows staged of 2" in r["message"]


def test_keep_first_at_a_position(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c"), (None, 1, "n"), (2, 10, "d")], "k long, at long, v string")
    assert sorted(r.v for r in validate.keep_first_at(df, "k", "at").collect()) == ["a", "c"]
    plan = validate.first_positions(df, "k", "at", "v")._jdf.queryExecution().executedPlan().toString()
    assert validate.first_positions(df, "k", "at")._jdf.queryExecution().executedPlan().toString().count("Sort") == 0, plan


def test_spreadsheet_times_ignore_the_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("3/11/2012 2:30",), ("3/11/2012 2:30:05",), ("11/4/2012",), ("2012-03-11 02:30:00",), ("13/45/2012",)], "created_at string")
            got = [r[0] for r in clean.cast_timestamps(df).selectExpr("cast(created_at as string)").collect()]
            assert got == ["2012-03-11 02:30:00", "2012-03-11 02:30:05", "2012-11-04 00:00:00", "2012-03-11 02:30:00", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    from ledgerline.session import checkpoint_root

    conf = SimpleNamespace(get=lambda k, d=None: d)
    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=context, conf=conf))


def test_scratch_is_cleared(spark):
    from ledgerline.session import clear_scratch, scratch_path

    path = scratch_path(spark, "some")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert clear_scratch(spark) >= 1
    assert not os.path.exists(path.removeprefix("file:"))


def test_a_created_target_without_rows_is_not_searched(spark, tmp_dir, monkeypatch):
    """A batch meets no key in an empty target: it is neither stored first nor joined; the next one is."""
    path, calls, real = os.path.join(tmp_dir, "orders"), [], load.anti_existing
    monkeypatch.setattr(load, "anti_existing", lambda new, *a: calls.append(1) or real(new, *a))
    load.create_target(spark, path, TABLES["orders"])
    batch = frame(spark, "orders", [order(1, "2012-01-01 00:00:00"), order(2, "2012-01-02 00:00:00")])
    assert load.load_table(spark, batch, "orders", path).rows_inserted == 2 and not calls
    assert load.load_table(spark, frame(spark, "orders", [order(2, "2012-01-02 00:00:00"), order(3, "2012-01-03 00:00:00")]), "orders", path, inclusive=True).rows_inserted == 1 and calls == [1]
    assert sorted(r.order_id for r in load.read_target(spark, path, TABLES["orders"]).collect()) == [1, 2, 3]
