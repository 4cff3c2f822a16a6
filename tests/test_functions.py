"""Truth tables for the scalar Column helpers (lenient casts, blank, geohash, geocoder)."""

from pyspark.sql import functions as F

from adlens.functions.geocode import parse_business_areas
from adlens.functions.geohash import geohash, with_geohash
from adlens.functions.scalar import (in_geo_box, is_blank, lenient_double, lenient_int,
                                     normalise_unknown, utf16_length)


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_lenient_int(spark):
    cases = {"5": 5, "+5": 5, "-7": -7, " 5 ": 0, "1.0": 0, "": 0, "99999999999": 0,
             "2147483647": 2147483647, "abc": 0, None: 0}
    got = _eval(spark, list(cases), lenient_int)
    assert got == list(cases.values())


def test_lenient_double(spark):
    cases = {" 2.5 ": 2.5, "1e3": 1000.0, "abc": 0.0, "inf": 0.0, "-inf": 0.0, "nan": 0.0,
             "": 0.0, None: 0.0, "1d": 1.0, "7": 7.0, ".5": 0.5}
    got = _eval(spark, list(cases), lenient_double)
    assert got == list(cases.values())
    special = _eval(spark, ["Infinity", "-Infinity"], lenient_double)
    assert special == [float("inf"), float("-inf")]


def test_blank(spark):
    blank = [None, "", " ", "\t\n", "　"]
    not_blank = [" ", " x", "a"]
    assert _eval(spark, blank + not_blank, is_blank) == [True] * 5 + [False] * 3


def test_normalise_unknown(spark):
    assert _eval(spark, ["未知", "", None, "4G"], normalise_unknown) == ["其他", "", None, "4G"]


def test_utf16_length(spark):
    assert _eval(spark, ["😀ab", "abc", "电视剧"], utf16_length) == [4, 3, 3]


def test_geo_box(spark):
    df = spark.createDataFrame([("73", "3"), ("136", "53"), ("72.99", "10"), ("100", "bad"), ("100", "30")],
                               "long string, lat string")
    assert [r[0] for r in df.select(in_geo_box("long", "lat")).collect()] == [True, True, False, False, True]


def test_geohash_golden(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (31.2304, 121.4737), (-90.0, -180.0), (90.0, 180.0)],
                               "lat double, lon double")
    got = [r[0] for r in df.select(geohash("lat", "lon")).collect()]
    assert got[0] == "u4pruy"
    assert got[1].startswith("wtw3")
    assert got[2] == "000000" and got[3] == "zzzzzz"
    staged = [r["g"] for r in with_geohash(df, "lat", "lon", "g").collect()]
    assert staged == got


def test_geocoder_parse(spark):
    three = ('{"status":"1","regeocode":{"addressComponent":{"businessAreas":['
             '{"location":"121.4737,31.2304","name":"东门","id":"7"},'
             '{"location":"121.4801,31.2351","name":"桥北","id":"8"},'
             '{"location":"121.4690,31.2288","name":"河湾","id":"9"}]}}}')
    cases = {
        three: "东门,桥北,河湾",
        '{"status":"0","regeocode":{"addressComponent":{"businessAreas":[{"name":"x"}]}}}': "",
        '{"status":1,"regeocode":{"addressComponent":{"businessAreas":[[]]}}}': "",
        '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[{"name":"A"},[],"s",{"name":"B"}]}}}': "A,B",
        '{"status":"1","regeocode":': "",
        '{"status":"1"}': "",
        '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[{"name":"A"},{"id":"7"}]}}}': "A,null",
        '{"regeocode":{"addressComponent":{"businessAreas":[{"name":"A"}]}}}': "",
    }
    assert _eval(spark, list(cases), parse_business_areas) == list(cases.values())
