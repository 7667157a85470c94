"""Files that an increment may meet (L3): pruning, and the same result as the whole target."""

import os
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import key_ranges, load
from ledgerline.schemas import TABLES
from ledgerline.sources.files import delete_line

SPEC = TABLES["orders"]


def _orders(spark, keys, day):
    base = load.align_columns(spark.createDataFrame([(int(k),) for k in keys], "order_id long").withColumn("created_at", F.lit(f"2012-01-{day:02d}").cast("timestamp_ntz")), SPEC)
    return base.coalesce(1)


def _load(spark, path, keys, day):
    return load.load_table(spark, _orders(spark, keys, day), "orders", path, lateness="60 days").rows_inserted


def _opened(spark, path, keys):
    target = load.read_target(spark, path, SPEC)
    held = key_ranges.may_hold(target, path, spark.createDataFrame([(k,) for k in keys], "order_id long"), SPEC)
    return 0 if held is None else len(held.inputFiles())


def test_scattered_increment_opens_only_files_that_may_hold_a_key(spark, tmp_dir):
    path = os.path.join(tmp_dir, "orders")
    for k in range(8):
        _load(spark, path, range(k * 100_000, k * 100_000 + 500), k + 1)
    assert len(load.read_target(spark, path, SPEC).inputFiles()) == 8
    # the smallest and largest key of this increment span every file
    assert _opened(spark, path, [5, 300_010, 700_400]) == 3
    assert _opened(spark, path, [5, 900_000]) == 1
    assert _opened(spark, path, [600, 150_000, -4, 10**12]) == 0
    assert _opened(spark, path, []) == 0
    # keys within the range of a band of a file, and files of one band
    assert _opened(spark, path, [499, 500]) == 1
    assert _load(spark, path, [5, 300_010, 600, 150_000, 900_000], 9) == 3
    assert _opened(spark, path, [600]) == 1 and _opened(spark, path, [601]) == 0 and _opened(spark, path, [550, 700]) == 1


def test_files_that_no_range_lists_are_opened(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "orders")
    _load(spark, path, range(100), 1)
    # a writer that is killed between the append and its ranges
    with monkeypatch.context() as m:
        m.setattr(key_ranges, "write_line", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            _load(spark, path, range(10**6, 10**6 + 100), 2)
    assert _opened(spark, path, [5]) == 2 and _opened(spark, path, [10**6]) == 1
    assert _load(spark, path, [5, 10**6 + 5, 77 * 10**6], 3) == 1
    assert _opened(spark, path, [5]) == 1  # that load listed both
    delete_line(spark, key_ranges._folder(path))
    assert _opened(spark, path, [5]) == 3
    assert _load(spark, path, [5, 6, -9], 4) == 1 and _opened(spark, path, [-9]) == 1


def test_increments_give_what_the_whole_target_gives(spark, tmp_dir, monkeypatch):
    """Random increments, also after folders of ranges were merged."""
    monkeypatch.setattr(key_ranges, "MAX_PARTS", 3)
    monkeypatch.setattr(key_ranges, "BAND_BITS", 3)
    rng = random.Random(4)
    path = os.path.join(tmp_dir, "orders")
    held: set[int] = set()
    for day in range(1, 9):
        at = rng.randint(-200, 200)
        keys = {rng.randint(at, at + 60) for _ in range(20)} | {rng.randint(-400, 400) for _ in range(3)}
        assert _load(spark, path, keys, day) == len(keys - held)
        held |= keys
        assert len(key_ranges._parts(spark, path)) <= 3
    got = [r.order_id for r in load.read_target(spark, path, SPEC).collect()]
    assert len(got) == len(held) and set(got) == held
    folders = {n for n in os.listdir(key_ranges._folder(path)) if not n.startswith(".")}
    assert folders == set(key_ranges._parts(spark, path))
    listed = {(r.file, r.band): (r.low, r.high) for r in key_ranges.key_ranges(spark, path).collect()}
    want: dict = {}
    for r in load.read_target(spark, path, SPEC).select("order_id", F.col("_metadata.file_name").alias("file")).collect():
        low, high = want.get((r.file, r.order_id >> 3), (r.order_id, r.order_id))
        want[r.file, r.order_id >> 3] = (min(low, r.order_id), max(high, r.order_id))
    assert listed == want


def test_stored_ranges_lie_in_order(spark, tmp_dir, monkeypatch):
    """Neighbours differ by little, so their differences store small: items whose keys have a band each."""
    monkeypatch.setattr(key_ranges, "BAND_BITS", 0)
    path = os.path.join(tmp_dir, "orders")
    keys = list(range(3000))
    random.Random(3).shuffle(keys)
    _load(spark, path, keys, 1)
    rows = key_ranges.key_ranges(spark, path).select(F.col("_metadata.file_name").alias("part"), "file", "band", F.monotonically_increasing_id().alias("at"))
    parts: dict = {}
    for r in rows.orderBy("at").collect():
        parts.setdefault(r.part, []).append((r.file, r.band))
    assert sum(map(len, parts.values())) == 3000
    assert all(p == sorted(p) for p in parts.values())
