"""The bucketed log: same rows as the plain one, no exchange below the sums and the label join, hot keys beside."""

import os

import pytest
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators import identity as I
from adlens.operators.tags import TagContext
from adlens.plans.profiles import resolve_identities, user_profiles
from adlens.sources.clustered_log import ClusteredLog
from adlens.sources.derived import derived_log
from fixtures_small import SF_SMALL

FAMILIES = ["ad", "device", "location", "keyword"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """A stored log; a third of the rows have no id at all."""
    frame = derived_log(spark, SF_SMALL)
    anonymous = F.substring("sessionid", 2, 10).cast("int") % 3 == 0
    path = str(tmp_path_factory.mktemp("log") / "log")
    frame.withColumns({c: F.when(~anonymous, F.col(c)) for c, _ in S.ID_COLUMNS}).write.parquet(path)
    return spark.read.schema(S.LOG_SCHEMA).parquet(path)


@pytest.fixture(scope="module")
def clustered(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered"))
    return ClusteredLog(spark, "clustered_test", path, buckets=8).write(log)


def test_no_exchange_below_the_sums(clustered):
    plan = _plan(clustered.settled_weights(TagContext(stop_words=["drama"]), FAMILIES))
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert _plan(clustered.weights(TagContext(stop_words=["drama"]), FAMILIES)).count("Exchange hashpartitioning") == 1


def test_sums_equal_those_of_the_plain_log(clustered, log):
    ctx = TagContext(stop_words=["drama"])
    got, want = clustered.weights(ctx, FAMILIES), user_profiles(log, ctx, FAMILIES)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_a_hot_key_is_no_bucket(clustered, log):
    hot = [r[0] for r in clustered.loose.select("user_key").distinct().collect()]
    assert S.OTHER in hot and len(hot) < clustered.buckets
    assert clustered.settled.filter(F.col("user_key").isin(hot)).isEmpty()
    assert clustered.settled.count() + clustered.loose.count() == log.count()


def test_labels_join_inside_the_buckets(clustered, log):
    labels = resolve_identities(log)
    clustered.write_labels(labels)
    assert "Exchange" not in _plan(clustered.settled_components(["sessionid"]))
    got = clustered.components(["sessionid"])
    want = I.attach_component(log, labels, keep=["sessionid"])
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_another_session_opens_the_folder(spark, clustered):
    other = ClusteredLog(spark.newSession(), "clustered_again", clustered.path, 8).open()
    assert other.settled.count() == clustered.settled.count()
    assert "Exchange" not in _plan(other.settled_weights(TagContext(), ["ad"]))


def test_empty_log_and_odd_names(spark, log, tmp_path):
    empty = ClusteredLog(spark, "clustered_empty", os.path.join(tmp_path, "e"), 4).write(log.limit(0))
    assert empty.weights(TagContext(), ["ad"]).isEmpty()
    with pytest.raises(ValueError):
        ClusteredLog(spark, "a; b", str(tmp_path))
