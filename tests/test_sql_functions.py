"""SQL functions give what the Column forms give, also on hard values, and stay in the JVM."""

import pytest
from pyspark.sql import functions as F

from adlens.functions import scalar
from adlens.functions.geocode import parse_business_areas
from adlens.functions.geohash import geohash6
from adlens.functions.sql_functions import register_sql_functions, sql_functions
from adlens.operators import tags as T
from adlens.operators.geo import business_names
from adlens.plans.catalog import QUERIES
from fixtures_small import SF_SMALL

TEXTS = [None, "", " ", "\u3000\t", "x", "abc", "12345678", "123456789", "a|bcd||TV\u7248|it's", "\U0001F600a|\U0001F600abcdefg",
         "5", " 5 ", "+7", "-0", "2147483648", "1e3", "NaN", "inf", "-Infinity", "0x1p3", "1d", "a,b,,", ",", "4G", "Wifi", "\u79fb\u52a8"]
RESPONSES = [None, "", "no json", '{"status":"0","regeocode":{"addressComponent":{"businessAreas":[{"name":"A"}]}}}',
             '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[{"name":"A"},[],"x",{"id":1}]}}}',
             '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[[]]}}}', '{"status":"1"}']


@pytest.fixture(scope="module")
def functions(spark):
    return register_sql_functions(spark, ["TV\u7248", "it's"])


def _same(frame, sql, column):
    rows = frame.select(F.expr(sql).alias("a"), column.alias("b")).collect()
    assert [str(r.a) for r in rows] == [str(r.b) for r in rows]


def test_scalars(spark, functions):
    frame = spark.createDataFrame([(x,) for x in TEXTS], "v string")
    _same(frame, "adlens_is_blank(v)", scalar.is_blank("v"))
    _same(frame, "adlens_lenient_int(v)", scalar.lenient_int("v"))
    _same(frame, "adlens_lenient_double(v)", scalar.lenient_double("v"))
    points = spark.createDataFrame([(a, b) for a in ("73", "136", "136.1", "x", None) for b in ("3", "53", "2.9", "")], "o string, a string")
    _same(points, "adlens_in_geo_box(o, a)", scalar.in_geo_box("o", "a"))


def test_cells_and_responses(spark, functions):
    points = [(a, o) for a in (None, -90.0, -45.3, 0.0, 57.64911, 90.0, 95.0) for o in (None, -180.0, 10.40744, 179.999, 180.0, 200.0)]
    frame = spark.createDataFrame(points, "a double, o double")
    _same(frame, "adlens_geohash6(a, o)", geohash6("a", "o"))
    _same(spark.createDataFrame([(r,) for r in RESPONSES], "r string"), "adlens_business_areas(r)", parse_business_areas("r"))


def test_tag_families(spark, functions):
    frame = spark.createDataFrame([(x, n, y) for x in TEXTS for n in (None, 0, 1, 3, 9, 10, 123, -4) for y in (None, "", "4G", "z")],
                                  "v string, n int, w string")
    v, n, w = F.col("v"), F.col("n"), F.col("w")
    _same(frame, "adlens_ad_tags(n, v, n)", T.ad_tag_array(n, v, n))
    _same(frame, "adlens_device_tags(n, v, w)", T.device_tag_array(n, v, w))
    _same(frame, "adlens_location_tags(v, w)", T.location_tag_array(v, w))
    _same(frame, "adlens_keyword_tags(v)", T.keyword_tag_array(v, ["TV\u7248", "it's"]))
    _same(frame, "adlens_business_tags(v)", F.transform(business_names(v), lambda x: F.struct(F.lit("business").alias("kind"), x.alias("tag"))))
    register_sql_functions(spark, [], "present")
    _same(frame, "adlens_ad_tags(n, v, n)", T.ad_tag_array(n, v, n, "present"))
    _same(frame, "adlens_keyword_tags(v)", T.keyword_tag_array(v))


@pytest.mark.parametrize("name", ["sql_row_tags", "sql_geohash_cells", "sql_regeo_parse"])
def test_plans_have_no_python(spark, name):
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names_are_stable(functions):
    assert functions == [f.name for f in sql_functions()] and len(set(functions)) == 12
