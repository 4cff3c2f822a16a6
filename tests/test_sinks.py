"""Sinks: report text lines, partitioned JSON, day-partitioned profiles."""

import os
import tempfile

from adlens.sources.sinks import report_lines, write_partitioned_json, write_profiles


def test_report_lines_format(spark):
    df = spark.createDataFrame([("P1", None, 3, 2, 1, 1, 0, 2, 1, 0.5, 1.25)],
                               "provincename string, cityname string, raw_req bigint, valid_req bigint, "
                               "ad_req bigint, shows bigint, clicks bigint, bids bigint, wins bigint, "
                               "win_price_k double, ad_payment_k double")
    line = report_lines(df, ["provincename", "cityname"]).first().value
    assert line == "(P1,null),3.0,2.0,1.0,1.0,0.0,2.0,1.0,0.5,1.25"


def test_partitioned_json(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="adlens-test-"), "j")
    df = spark.createDataFrame([("P1", "C1", 2), ("", "C2", 1)], "provincename string, cityname string, ct bigint")
    write_partitioned_json(df, ["provincename", "cityname"], out)
    assert os.path.isdir(os.path.join(out, "provincename=P1", "cityname=C1"))
    back = spark.read.schema("ct bigint, provincename string, cityname string").json(out)
    got = sorted((str(r.provincename), r.cityname, r.ct) for r in back.collect())
    assert got == [("None", "C2", 1), ("P1", "C1", 2)]  # '' lands in the default partition -> null


def test_profiles_day_overwrite(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="adlens-test-"), "profiles")
    a = spark.createDataFrame([("u1", "(K1,1)")], "user_key string, tags string")
    b = spark.createDataFrame([("u2", "(K2,2)")], "user_key string, tags string")
    write_profiles(a, out, "20190922")
    write_profiles(b, out, "20190923")
    write_profiles(b, out, "20190922")  # re-run of one day replaces that day only
    back = spark.read.parquet(out)
    got = sorted((r.dt, r.user_key) for r in back.collect())
    assert got == [(20190922, "u2"), (20190923, "u2")] or got == [("20190922", "u2"), ("20190923", "u2")]
