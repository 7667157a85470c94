"""Session construction and the shared scratch folder.

Scratch data (round-trip CSVs, load targets written by registered queries,
checkpoints) always lives below the cluster's ``spark.checkpoint.dir``. Only
when the session has none (local tests) do we pick a fresh folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str = "local[*]",
    app_name: str = "ledgerline",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session configured the way every operator here expects.

    * UTC session zone (timestamps in the data model are ``timestamp_ntz``;
      the zone only matters for values a caller brings in as ``timestamp``).
    * AQE with partition coalescing and skew-join splitting: hot keys
      (one user, one month, one channel holding a large share of rows) are
      split at run time instead of landing in a single task.
    * No web UI.
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session; a folder of our own is set only where none is
    configured and everything runs on one machine (tests). On a cluster a missing setting is an error:
    executors would not see a folder of the driver."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None
        )
        if not conf_dir:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            conf_dir = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(conf_dir)
        root = sc.getCheckpointDir()
    return root.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` below the shared folder (with these writer options) and read it back: its plan runs once, whatever reads it afterwards."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has made, once no frame that reads them is needed;
    returns their number."""
    from ledgerline.sources.files import delete_path

    done = 0
    while _SCRATCH:
        delete_path(spark, _SCRATCH.pop())
        done += 1
    return done
