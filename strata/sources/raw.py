"""Raw CSV landing files: every field as text, NA tokens as null, file order.

* no schema inference (it costs an extra pass and drifts between runs);
  every column is read as a string, leading zeros and blanks kept;
* the pandas NA tokens (``NA``, ``NULL``, ``n/a`` ...) become null, and so
  does an empty field, quoted or not;
* a UTF-8 byte-order mark is removed from the first header name;
* ``_seq`` records the physical order of rows: (file name, block offset,
  row position). "First row wins" rules (key validation) sort by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import null_tokens

SEQ = "_seq"
BOM = "\ufeff"


def csv_options(multi_line: bool = True) -> dict:
    """Options of every CSV reader of the library, batch or stream. Quotes are
    doubled inside quoted fields. ``multi_line``: fields may hold line ends,
    so a file is read by one task; without it files are split."""
    return {"header": True, "mode": "PERMISSIVE", "multiLine": multi_line, "escape": '"', "quote": '"'}


def csv_header(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """Column names of the files at ``path``, in file order, as written."""
    return spark.read.options(**csv_options(multi_line), inferSchema=False).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str, *, with_seq: bool = True,
                 expected_columns=None, multi_line: bool = True, bad_record: str | None = None) -> DataFrame:
    """``bad_record`` names a column that holds the text of a record with too
    many or too few fields, null for the others."""
    header = csv_header(spark, path, multi_line)
    names = [c.replace(BOM, "") for c in header]
    fields = [T.StructField(c, T.StringType()) for c in header]
    options = csv_options(multi_line)
    if bad_record:
        fields.append(T.StructField(bad_record, T.StringType()))
        options["columnNameOfCorruptRecord"] = bad_record
    df = spark.read.options(**options).schema(T.StructType(fields)).csv(path)
    df = df.toDF(*names, *([bad_record] if bad_record else []))
    if expected_columns is not None:
        missing = [c for c in expected_columns if c not in names]
        if missing:
            raise ValueError(f"{path}: header lacks columns {missing}")
    out = [null_tokens(c).alias(c) for c in names] + ([F.col(bad_record)] if bad_record else [])
    if with_seq:
        out.append(F.struct(
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row")).alias(SEQ))
    return df.select(*out)


# Physical row order of a Parquet scan: a hash of the file path and the row
# index inside the file.
ROW_ORDER = ("_file", "_row")


def with_row_order(df: DataFrame) -> DataFrame:
    """``df`` (a Parquet scan) plus the ``ROW_ORDER`` columns.

    The values depend only on the files, not on how a scan is split, so two
    scans of the same table in one plan agree on them: used as the last
    tiebreaker of "first row wins" rules. A 64-bit hash keeps shuffled rows
    narrow; a tie would need equal order columns, an equal row index and a
    hash collision between two file paths.
    """
    return df.select("*", F.xxhash64(F.col("_metadata.file_path")).alias(ROW_ORDER[0]),
                     F.col("_metadata.row_index").alias(ROW_ORDER[1]))
