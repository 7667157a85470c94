"""CSV extraction: header row, UTF-8, every column a string, pandas-style NA
tokens to NULL.

No schema is supplied and nothing is inferred: columns are named from the
header (a supplied schema would bind by position; the loader binds by name)
and typed later by the cleaner with ``try_cast``. Undecodable bytes become
U+FFFD, as with ``encoding_errors='replace'``.

Quoting is the standard one: fields in double quotes, a quote inside as two, backslashes as
they are; with ``multiline`` a quoted field may span lines. Rows with more fields than the header, and quoted
fields that never close, are malformed: a scan fails on them (as the reference's reader does), or
keeps them apart in ``CORRUPT`` for the caller to count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# pandas' default NA tokens for read_csv (na_values default set).
PANDAS_NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


FILE_ORDER = "_file_order"


def na_to_null(df: DataFrame, tokens=PANDAS_NA_TOKENS, skip=(FILE_ORDER,)) -> DataFrame:
    """Map NA tokens (exact, case-sensitive match) to NULL in every column."""
    toks = list(tokens)
    return df.select(
        *[
            F.col(f"`{c}`")
            if c in skip
            else F.when(F.col(f"`{c}`").isin(toks), F.lit(None).cast("string"))
            .otherwise(F.col(f"`{c}`"))
            .alias(c)
            for c in df.columns
        ]
    )


#: standard quoting, for batch and stream readers alike
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    # quoted empty fields come as '' (the NA tokens make them NULL), other empty ones as NULL
    "emptyValue": "",
    "nullValue": "\0",
}
#: text of the first field beyond the header, on malformed rows
CORRUPT = "_surplus_field"
FAIL, COUNT = "fail", "count"


def header_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder, from its header."""
    return spark.read.options(**CSV_OPTIONS).option("inferSchema", False).csv(path).columns


def string_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str,
    na_tokens=PANDAS_NA_TOKENS,
    with_order: bool = False,
    multiline: bool = False,
    malformed: str = FAIL,
) -> DataFrame:
    """Scan one CSV file (or a folder of CSV parts) as all-string columns.

    ``with_order`` adds ``_file_order``, a struct that sorts rows in the
    order they appear in the files (path, split start, position in the
    split), taken on the scan itself before any shuffle. ``multiline``
    (quoted fields spanning lines) makes each file a single split, so it is
    off unless a source needs it. ``malformed``: ``fail`` raises on a row with too many
    fields; ``count`` keeps such rows, with the surplus text in ``_surplus_field`` (NULL on good rows).
    Short rows are filled with NULL, as pandas does."""
    columns = header_columns(spark, path)
    raw = spark.read.schema(string_schema([*columns, CORRUPT])).options(**CSV_OPTIONS).option("multiLine", multiline).csv(path)
    if with_order:
        raw = raw.withColumn(
            FILE_ORDER,
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("pos"),
            ),
        )
    if malformed == FAIL:
        raw = fail_on_malformed(raw)
    return na_to_null(raw, na_tokens, skip=(FILE_ORDER, CORRUPT))


#: input splits up to which their order is broadcast (some hundred bytes each)
MAX_BROADCAST_SPLITS = 50_000
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def with_file_position(df: DataFrame, out: str) -> DataFrame:
    """Replace ``_file_order`` of a *stored* scan by ``out``, one long that sorts rows the same way: the rank of the row's
    split among all (path, start), then the row's number in it. Only stored rows have a fixed order: a scan that runs
    again may be cut into other splits."""
    at = F.col(FILE_ORDER)
    splits = df.select(at["file"].alias("_file"), at["block"].alias("_block")).distinct()
    few = splits.limit(MAX_BROADCAST_SPLITS + 1).count() <= MAX_BROADCAST_SPLITS
    # a row per input split is numbered in one task
    ranked = splits.select("*", (F.row_number().over(Window.orderBy("_file", "_block")) - 1).alias("_split"))
    in_split = at["pos"].bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    joined = df.withColumns({"_file": at["file"], "_block": at["block"]}).join(F.broadcast(ranked) if few else ranked, ["_file", "_block"])
    position = F.shiftleft(F.col("_split").cast("long"), _ROW_BITS).bitwiseOR(in_split)
    return joined.select(*[c for c in df.columns if c != FILE_ORDER], position.alias(out))


def fail_on_malformed(raw: DataFrame) -> DataFrame:
    """A filter that raises on rows with too many fields, whichever columns are read later."""
    error = F.raise_error(F.concat(F.lit("malformed CSV row: more fields than the header, from "), F.col(CORRUPT)))
    return raw.filter(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(error.cast("boolean"))).drop(CORRUPT)


def csv_path(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}.csv"


#: rows of one compressed part file: such a file is read by one task
MAX_RECORDS_COMPRESSED = 1_000_000


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write a DataFrame as a header CSV folder (standard quoting, the layout ``read_csv``
    scans). NULL is written as an empty field. Compressed parts hold a bounded number of rows."""
    writer = df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", MAX_RECORDS_COMPRESSED)
    writer.csv(path)
