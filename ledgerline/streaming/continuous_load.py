"""The incremental loader driven by Structured Streaming.

A file-source stream over a landing folder of CSV drops feeds each
micro-batch through the same steps as the batch pipeline (clean -> keep the
first row per key -> watermark filter -> insert-if-absent append). The
stream's checkpoint (in the shared checkpoint folder) records which files
were consumed, so a restarted query neither skips nor re-reads a file; and
because the append is insert-if-absent on the primary key, a micro-batch
replayed after a failure writes nothing twice.

The watermark is taken once, when a run starts, and kept beside the stream's checkpoint until the
run has ended well; every micro-batch of the run filters by it. Files are consumed in the order they
landed, and within a batch the first row of a key in that order wins, so the result does
not depend on how the files are split into batches.

``trigger(availableNow=True)`` processes everything that has landed and
stops, which is the scheduled-batch behaviour of the reference; a
processing-time trigger turns the same code into a continuous loader (one run, one watermark).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.clean import clean_dataframe
from ledgerline.operators.load import LoadResult, load_table, target_watermark
from ledgerline.operators.validate import keep_first
from ledgerline.schemas import spec_for
from ledgerline.session import scratch_path
from ledgerline.sources.csv import CORRUPT, CSV_OPTIONS, FILE_ORDER, fail_on_malformed, header_columns, na_to_null, string_schema
from ledgerline.sources.files import delete_line, read_line, write_line


def landing_schema(spark: SparkSession, sample_path: str) -> T.StructType:
    """All-string schema named from the CSV header (streams need a schema
    up front; reading only the header of existing files gives it)."""
    return string_schema(header_columns(spark, sample_path))


@dataclass
class StreamLoad:
    table: str
    target_path: str
    run_ts: str
    watermark: str | None = None
    results: list[LoadResult] = field(default_factory=list)

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        spec = spec_for(self.table)
        # position inside the split is added here, on the micro-batch (a
        # plain batch plan: scan -> project, no shuffle before this point)
        batch = batch.withColumn(
            FILE_ORDER,
            F.struct(
                F.col("_landed").alias("landed"),
                F.col("_file").alias("file"),
                F.col("_block").alias("block"),
                F.monotonically_increasing_id().alias("pos"),
            ),
        ).drop("_landed", "_file", "_block")
        cleaned = clean_dataframe(
            batch,
            self.table,
            self.run_ts,
            order_col=FILE_ORDER,
            drop_exact_duplicates=spec is None,  # keep-first removes exact copies too
        )
        if spec is not None:
            cleaned = keep_first(cleaned, spec.pk, [FILE_ORDER], keep_null_keys=False)
        self.results.append(
            load_table(
                spark,
                cleaned.drop(FILE_ORDER),
                self.table,
                self.target_path,
                unique_keys=spec is not None,
                watermark=(self.watermark,),
            )
        )


def _mark_path(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}.run-mark"


def _run_mark(spark: SparkSession, checkpoint: str, table: str, target_path: str) -> str | None:
    """The watermark of the run: that of an unfinished run, else the target's, noted for a restart."""
    line = read_line(spark, _mark_path(checkpoint))
    if line is None:
        line = target_watermark(spark, target_path, spec_for(table)) or ""
        write_line(spark, _mark_path(checkpoint), line)
    return line or None


def start_stream_load(
    spark: SparkSession,
    landing_dir: str,
    table: str,
    target_path: str,
    run_ts: str,
    schema: T.StructType,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    multiline: bool = False,
):
    """Start the loader; returns (StreamingQuery, StreamLoad)."""
    checkpoint = checkpoint or scratch_path(spark, f"stream-{table}")
    reader = spark.readStream.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).options(**CSV_OPTIONS).option("multiLine", multiline)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = fail_on_malformed(reader.csv(landing_dir))
    marks = {"_landed": "file_modification_time", "_file": "file_path", "_block": "file_block_start"}
    raw = raw.withColumns({k: F.col(f"_metadata.{v}") for k, v in marks.items()})
    sink = StreamLoad(table, target_path, run_ts, _run_mark(spark, checkpoint, table, target_path))
    writer = (
        na_to_null(raw, skip=tuple(marks))
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute"
    )
    return writer.start(), sink


def run_available(
    spark: SparkSession,
    landing_dir: str,
    table: str,
    target_path: str,
    run_ts: str,
    schema: T.StructType,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> list[LoadResult]:
    """Process every file that has landed since the last run, then stop."""
    query, sink = start_stream_load(
        spark,
        landing_dir,
        table,
        target_path,
        run_ts,
        schema,
        checkpoint,
        available_now=True,
        max_files_per_trigger=max_files_per_trigger,
    )
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to caller
        raise query.exception()
    delete_line(spark, _mark_path(checkpoint))
    return sink.results
