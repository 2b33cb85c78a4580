"""Run-level bookkeeping: quality counters, the file catalog, the audit row.

All three are aggregates computed by Spark; nothing is counted on the
driver. Counters come from one pass over the flagged frame (or from an
``Observation`` attached to the write, see ``observed_counts``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.scalar import elapsed_seconds
from strata.sources.raw import read_raw_csv
from strata.specs import FAILED_STATES, PIPELINE_NAME

# Audit status words and message prefix.
STATUS_FAILED = "FAILED"
STATUS_SUCCESS = "SUCCESS"
FAILED_PREFIX = "Failed tasks: "


def _sum_flag(cond):
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def validation_counts(flagged: DataFrame, dataset: str | None = None) -> DataFrame:
    """One row: original / valid / rejected (by reason) counts."""
    cols = [
        F.count(F.lit(1)).alias("original_rows"),
        _sum_flag(F.col("is_valid")).alias("valid_rows"),
        _sum_flag(~F.col("is_valid")).alias("rejected_rows"),
        _sum_flag(F.col("reject_reason") == "null_key").alias("null_key_rows"),
        _sum_flag(F.col("reject_reason") == "duplicate_key").alias("duplicate_key_rows"),
    ]
    out = flagged.agg(*cols)
    if dataset is not None:
        out = out.select(F.lit(dataset).alias("dataset_name"), "*")
    return out


def observed_counts(flagged: DataFrame, name: str = "validation"):
    """Attach the same counters to a write: ``(frame, observation)``.

    After the frame's action (e.g. the layer write) ``observation.get``
    holds the counts, without a second pass over the data.
    """
    obs = Observation(name)
    return flagged.observe(
        obs,
        F.count(F.lit(1)).alias("original_rows"),
        _sum_flag(F.col("is_valid")).alias("valid_rows"),
        _sum_flag(~F.col("is_valid")).alias("rejected_rows"),
    ), obs


def catalog(spark: SparkSession, entries, as_of=None, one_line=()) -> DataFrame:
    """One row per stored dataset file with its record count.

    ``entries``: iterable of (dataset_name, layer, path, file_format) and, if
    only some rows belong to the dataset, a condition on them. CSV files are
    counted by record, as the raw reader reads them; those whose paths are in
    ``one_line`` hold no line end inside a field and are read in splits.
    Other counts are zero-column scans. All are unioned into one plan, so the whole catalog is
    one job.
    """
    frames = []
    for name, layer, path, fmt, *only in entries:
        df = read_raw_csv(spark, path, with_seq=False, multi_line=path not in one_line) if fmt == "csv" else spark.read.format(fmt).load(path)
        if only:
            df = df.where(only[0])
        file_name = path.rstrip("/").rsplit("/", 1)[-1]
        frames.append(df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("dataset_name"), F.lit(layer).alias("layer"),
            F.lit(file_name).alias("file_name"), F.lit(fmt).alias("file_format"),
            "record_count"))
    out = reduce(DataFrame.unionByName, frames)
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast(T.TimestampNTZType())
    return out.withColumn("updated_at", stamp)


def iso_text(ts):
    """ISO text of a timestamp; microseconds only where there are some."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.date_format(ts, "SSSSSS") == "000000", whole).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def audit_record(stages: DataFrame, run_id, start_time, end_time,
                 task_col: str = "task_id", state_col: str = "state",
                 pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """One audit row from a task-status table.

    status FAILED when any task is failed / upstream_failed; the message
    lists those tasks (sorted, so the text is deterministic).
    """
    failed = F.col(state_col).isin(*FAILED_STATES)
    names = F.array_sort(F.collect_list(F.when(failed, F.col(task_col))))
    start = F.lit(start_time).cast(T.TimestampNTZType())
    end = F.lit(end_time).cast(T.TimestampNTZType())
    agg = stages.agg(names.alias("_failed"))
    has_failed = F.size("_failed") > 0
    return agg.select(
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        iso_text(start).alias("start_time"),
        iso_text(end).alias("end_time"),
        F.when(has_failed, F.lit(STATUS_FAILED)).otherwise(F.lit(STATUS_SUCCESS)).alias("status"),
        elapsed_seconds(start, end).alias("execution_seconds"),
        F.when(has_failed, F.concat(F.lit(FAILED_PREFIX), F.concat_ws(", ", "_failed")))
         .otherwise(F.lit("")).alias("error_message"))
