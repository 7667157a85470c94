"""What executors start and hold beside the work: part files of small tables, Python daemons, memory that waiting workers keep."""

import contextlib

import pyarrow as pa

from ledgerline.llm import decontamination, near_dedup
from ledgerline.llm import textbuf as tb

SETTINGS = {"spark.sql.shuffle.partitions": "160", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@contextlib.contextmanager
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        yield max(spark.sparkContext.defaultParallelism, 160 // tb.PARTITIONS_A_FILE)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_narrow_tables_share_files(spark):
    with many_partitions(spark) as files:
        links = spark.range(4000).selectExpr("id - id % 4 as a", "id as b")
        found = near_dedup.components(links)
        assert len(found.inputFiles()) <= files
        assert {tuple(r) for r in found.collect()} == {(k, k - k % 4) for k in range(4000) if k % 4}


def test_a_wide_table_keeps_its_tasks(spark):
    with many_partitions(spark) as files:
        rows = spark.range(0, 4000, 1, 40)
        assert len(tb.materialized(rows, "wide").inputFiles()) == 40
        narrow = tb.materialized(rows.groupBy("id").count(), "narrow", narrow=True)
        assert len(narrow.inputFiles()) <= files and narrow.distinct().count() == 4000


def test_hits_need_no_worker_of_their_own(spark, docs, capsys):
    none = tb.no_rows(spark, decontamination.HITS)
    assert none.count() == 0
    assert [(f.name, f.dataType) for f in none.schema] == [(f.name, f.dataType) for f in spark.createDataFrame([], decontamination.HITS).schema]
    benchmark = spark.createDataFrame([("i", "two words")], "item_id string, text string")
    found = decontamination.decontaminate(docs, benchmark)
    capsys.readouterr()
    found.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    nothing = decontamination.decontaminate(docs, benchmark.where("item_id is null"))
    assert nothing.count() == docs.count() and nothing.where("size(items) > 0 or ranges is not null").count() == 0


def test_a_task_gives_back_memory_at_its_end(monkeypatch):
    done = []
    monkeypatch.setattr(tb, "give_back", lambda: done.append(1))
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["ab", None, "c" * 40])})
    for rows, _, _ in tb.text_slices([batch, batch], 8):
        assert rows.num_rows and not done
    assert done == [1]
