"""The platform's batch jobs as functions over paths (P1-P4): what a user runs day to day.

Each job reads its inputs, builds one declarative plan and writes its outputs; nothing is
collected to the driver. Output folders follow the platform's jobs: one text report per
dimension, the province/city counts as partitioned JSON, profiles as day partitions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from adlens.operators.tags import FAMILIES_V1, FAMILIES_V2, TagContext
from adlens.plans import profiles as P
from adlens.plans import reports as R
from adlens.sources.dictionaries import load_app_dict, load_stopwords
from adlens.sources.rawlog import ingest_raw_log
from adlens.session import Scratch
from adlens.sources.sinks import (read_log, write_log, write_partitioned_json, write_profiles,
                                  write_text_report)
from adlens.operators.merge import profile_chunks

REPORT_KEYS = {
    "location": ["provincename", "cityname"], "os": ["os"], "device": ["device"],
    "network": ["network"], "carrier": ["carrier"], "channel": ["channel"],
}


def etl_job(spark: SparkSession, raw_path: str, log_path: str, mode: str = "errorifexists") -> None:
    """Raw comma-separated lines -> typed Snappy Parquet log."""
    write_log(ingest_raw_log(spark, raw_path), log_path, mode)


def report_jobs(spark: SparkSession, log_path: str, app_dict_path: str | None, out_dir: str,
                mode: str = "errorifexists") -> None:
    """The seven KPI text reports and the province/city count JSON, from one pass over the log."""
    parts = stored_report_parts(spark, read_log(spark, log_path))
    for name, fn in R.REPORTS_FROM_PARTS.items():
        write_text_report(fn(parts), REPORT_KEYS[name], os.path.join(out_dir, name), mode)
    if app_dict_path:
        app = R.app_from_parts(parts, load_app_dict(spark, app_dict_path, keep_trailing=True))
        write_text_report(app, ["app"], os.path.join(out_dir, "app"), mode)
    write_partitioned_json(R.city_count_from_parts(parts), ["provincename", "cityname"],
                           os.path.join(out_dir, "city_count"), mode)


def stored_report_parts(spark: SparkSession, log: DataFrame) -> DataFrame:
    """The log summed by all report columns at once, stored: the reports' only pass over the log."""
    return Scratch(spark).write(R.report_parts(log), "report_parts")[0]


def _context(spark: SparkSession, app_dict_path: str | None, stopwords_path: str | None,
             geo_dim: DataFrame | None) -> TagContext:
    ctx = TagContext(geo_dim=geo_dim)
    if app_dict_path:
        ctx.app_dict = load_app_dict(spark, app_dict_path, keep_trailing=False)
    if stopwords_path:
        ctx.stop_words = load_stopwords(spark, stopwords_path)
    return ctx


def profile_job(spark: SparkSession, log_path: str, out_path: str, dt: str,
                app_dict_path: str | None = None, stopwords_path: str | None = None,
                geo_dim: DataFrame | None = None, resolve_people: bool = True,
                deny_ids: list[str] | None = None) -> None:
    """P3 (``resolve_people=False``: one profile per primary id, six families) or
    P4 (one profile per resolved person, five families), written as rendered day partitions.
    ``deny_ids``: prefixed placeholder ids that identify nobody."""
    log = read_log(spark, log_path)
    ctx = _context(spark, app_dict_path, stopwords_path, geo_dim)
    if resolve_people:
        weights = P.person_profiles(log, ctx, FAMILIES_V2, deny_ids=deny_ids)
        rendered = profile_chunks(weights, "component").withColumnRenamed("component", "profile_key")
    else:
        weights = P.user_profiles(log, ctx, FAMILIES_V1, deny_ids)
        rendered = profile_chunks(weights, "user_key").withColumnRenamed("user_key", "profile_key")
    write_profiles(rendered, out_path, dt)
