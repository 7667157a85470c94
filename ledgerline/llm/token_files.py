"""Token-id output: Parquet list columns with controlled encodings, row groups and page indexes.

Method. Documents are dealt to files by ranges of doc_id (ties by a hash of the text), sorted within, encoded and
written as Parquet: the ids as a list column (format version 2: dictionary pages of token ids, delta packing where a
dictionary does not pay), lengths and file-local starts as integers (delta packed). Row-group and page sizes
are parameters, and column and offset indexes are part of every file, so a read of a few documents or of
the metadata alone touches few pages. ``read`` adds each document's global start: one prefix sum over the files' totals.

Tokens come from ``bpe`` (checked equal to the tokenizers library, and faster on one core), and the end id follows each text.

Defined results: null and empty texts are the end id alone; null ids come first; repeated ids are adjacent, in order of a hash of the text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import bpe
from ledgerline.llm import textbuf as tb

END_ID = 2
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
SCHEMA = "file int, doc_id long, local_start long, n_tokens long, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        v = bpe.vocabulary(path)
        part, at = TaskContext.get().partitionId(), 0
        for rows, data, off in tb.text_slices(batches, bpe.SLICE):
            ids, o = v.encode(data, off)
            n = len(o) - 1
            full = np.insert(ids, o[1:], end_id).astype(np.int32)
            o = o + np.arange(n + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    rows.column("doc_id"),
                    pa.array(at + o[:-1], pa.int64()),
                    pa.array(np.diff(o), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(full)),
                ],
                ["file", "doc_id", "local_start", "n_tokens", "ids"],
            )
            at += int(o[-1])

    return run


def write(docs: DataFrame, out: str, tokenizer: str, end_id: int = END_ID, files: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES, page_bytes: int = PAGE_BYTES) -> None:
    """Write the token files of all rows to the folder ``out``, in ascending doc_id order."""
    files = files or tb.shuffle_tasks(docs.sparkSession)
    ranged = tb.id_text(docs).withColumn("tie", F.xxhash64("text")).repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    (
        ranged.select("doc_id", "text")
        .mapInArrow(_encode(tokenizer, end_id), SCHEMA)
        .write.option("parquet.writer.version", "v2")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.enable.dictionary", "true")
        .option("compression", "zstd")
        .parquet(out)
    )


def read(spark: SparkSession, out: str, columns: tuple[str, ...] = ("ids",)) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and the chosen columns of the files in ``out``."""
    table = spark.read.schema(SCHEMA).parquet(out)
    totals = table.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    # one row a file: their number is the parameter ``files``
    before = totals.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("before"))
    return table.join(F.broadcast(before), "file").select("doc_id", (F.col("before") + F.col("local_start")).alias("start"), "n_tokens", *columns)


def _crc(batches):
    for batch in batches:
        ids = batch.column("ids")
        o = ids.offsets.to_numpy()
        flat = ids.values.to_numpy().astype("<u4", copy=False)
        crc = [zlib.crc32(flat[a:b]) for a, b in zip(o[:-1], o[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of a table from ``read``."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
