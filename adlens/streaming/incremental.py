"""Incremental reports and profiles with Structured Streaming.

The batch operators are plain DataFrame transformations, so the same ``kpi_report`` and
``merge_tags`` run on a streaming DataFrame: new log files in a folder are read as they
arrive, partial aggregates are kept in the state store (one row per report key, or per
(user, kind, tag) for profiles) and each trigger emits the updated rows. State and
progress live under a reliable checkpoint location, so a restarted query resumes where
it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adlens import schema as S
from adlens.operators.kpi import kpi_report
from adlens.operators.merge import merge_tags
from adlens.operators.tags import FAMILIES_V1, TagContext
from adlens.plans.profiles import user_tag_long


def read_log_stream(spark: SparkSession, log_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of typed log rows from Parquet files landing in ``log_dir``."""
    reader = spark.readStream.schema(S.LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(log_dir)


def kpi_report_stream(log_stream: DataFrame, dims: list) -> DataFrame:
    """The nine-metric report as a running aggregation."""
    return kpi_report(log_stream, dims)


def user_profile_stream(log_stream: DataFrame, ctx: TagContext,
                        families: list[str] = FAMILIES_V1) -> DataFrame:
    """Running tag weights per (user, kind, tag); dimensions in ``ctx`` are static tables.

    The state holds one row per (user, kind, tag): it is the cumulative profile table
    itself and grows with the number of users, not with the number of events. For
    per-day profiles, run one query per day folder (or add the day to the grouping) so
    old state can be dropped.
    """
    return merge_tags(user_tag_long(log_stream, ctx, families), "user_key")


def start(df: DataFrame, checkpoint_location: str, sink: str = "memory", query_name: str | None = None,
          output_mode: str = "update", path: str | None = None, available_now: bool = False,
          foreach_batch=None) -> StreamingQuery:
    """Start a streaming aggregation with the given sink (``memory``, ``parquet`` via
    ``foreach_batch``, console ...)."""
    w = df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_location)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(sink)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start(path) if path else w.start()
