"""Streaming KPI report and profiles equal the batch results over the same files."""

import os
import tempfile

from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators.tags import TagContext
from adlens.plans import reports as R
from adlens.plans.profiles import user_profiles
from adlens.sources.derived import derived_log
from adlens.streaming.incremental import (kpi_report_stream, read_log_stream, start,
                                          user_profile_stream)
from fixtures_small import SF_SMALL


def _land_two_batches(spark):
    d = tempfile.mkdtemp(prefix="adlens-stream-")
    log = derived_log(spark, SF_SMALL)
    first = log.filter(F.substring("sessionid", 2, 10).cast("int") % 2 == 0)
    second = log.filter(F.substring("sessionid", 2, 10).cast("int") % 2 == 1)
    first.write.parquet(os.path.join(d, "in", "b1"))
    second.write.parquet(os.path.join(d, "in", "b2"))
    return d, log


def _rows(df, keys):
    return sorted(tuple(r[k] for k in keys) for r in df.collect())


def test_streaming_kpi_matches_batch(spark):
    d, log = _land_two_batches(spark)
    stream = read_log_stream(spark, os.path.join(d, "in", "*"), max_files_per_trigger=1)
    q = start(kpi_report_stream(stream, ["provincename", "cityname"]), os.path.join(d, "ckpt"),
              query_name="kpi_stream_test", output_mode="complete", available_now=True)
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM kpi_stream_test")
    keys = ["provincename", "cityname"] + S.KPI_NAMES
    assert _rows(got, keys) == _rows(R.report_location(log), keys)


def test_streaming_profiles_match_batch(spark):
    d, log = _land_two_batches(spark)
    ctx = TagContext(stop_words=["drama"])
    stream = read_log_stream(spark, os.path.join(d, "in", "*"))
    q = start(user_profile_stream(stream, ctx, ["ad", "device", "location", "keyword"]),
              os.path.join(d, "ckpt2"), query_name="profile_stream_test", output_mode="complete",
              available_now=True)
    q.awaitTermination(300)
    keys = ["user_key", "kind", "tag", "weight"]
    batch = user_profiles(log, ctx, ["ad", "device", "location", "keyword"])
    assert _rows(spark.sql("SELECT * FROM profile_stream_test"), keys) == _rows(batch, keys)
