"""Tags exploded as plain texts equal the arrays of tags, and no function runs per array item."""

import pytest
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.geohash import geohash
from adlens.functions.scalar import is_blank, not_blank, utf16_length, utf16_length_between
from adlens.operators import geo as G
from adlens.operators.merge import merge_tags
from adlens.operators.tags import FAMILIES_V1, TagContext, row_tag_array, row_tags
from adlens.plans import catalog, profiles
from adlens.plans.profiles import user_tag_long

ODD = ["", " ", None, "　", "x", " ", " ", "​", "电视剧", "\t\n", "K", "a|bc|abc||😀😀😀😀|😀😀😀😀😀|abcdefgh|abcdefghi|电视剧|drama"]


def _log(spark):
    defaults = {"S": "", "I": 0, "D": 0.0}
    rows = []
    for i in range(96):
        r = {"sessionid": f"s{i}", "adspacetype": [None, -1, 0, 5, 9, 10][i % 6], "adplatformproviderid": [None, 7][i % 2],
             "client": [None, 0, 1, 3][i % 4], "long": ["116.3", "bad", "NaN", None][i % 4], "lat": "39.9"}
        for k, c in enumerate(["adspacetypename", "appname", "networkmannername", "ispname", "provincename", "cityname", "keywords", "imei"]):
            r[c] = ODD[(i + 5 * k) % len(ODD)]
        r["appid"] = f"app{i % 3}"
        rows.append(tuple(r.get(n, defaults[k]) for n, k in S.LOG_COLUMNS))
    return spark.createDataFrame(rows, S.LOG_SCHEMA)


def _ctx(spark):
    cell = spark.sql("SELECT 39.9D AS a, 116.3D AS o").select(geohash("a", "o", 6).alias(G.CELL))
    return TagContext(app_dict=spark.createDataFrame([("app0", "zero")], "appid string, appname_dict string"),
                      stop_words=["电视剧", "drama"], geo_dim=cell.withColumn("business_areas", F.lit("A,,B,keyword,,")))


def test_texts_equal_arrays(spark):
    log, ctx = _log(spark), _ctx(spark)
    arrays = row_tag_array(log, FAMILIES_V1, ctx, "t").select("sessionid", F.explode("t").alias("t")).select("sessionid", "t.*")
    want, got = (sorted(map(tuple, x.collect()), key=repr) for x in (arrays, row_tags(log, FAMILIES_V1, ctx, ["sessionid"])))
    assert got == want and {"business", "keyword", "ad", "app", "device", "location"} == {k for _, k, _ in got}


def test_no_function_per_item(spark):
    plan = merge_tags(user_tag_long(_log(spark), _ctx(spark)), "user_key")._jdf.queryExecution().toString()
    assert "lambdafunction" not in plan and "conv(" not in plan


@pytest.mark.parametrize("precision", [1, 2, 5, 6, 7, 12])
def test_geohash_is_the_bisection(spark, precision):
    points = [(0.0, 0.0), (-90.0, -180.0), (90.0, 180.0), (39.92324, 116.3906), (-33.8, 151.2), (57.64911, 10.40744), (12.0, -0.0001)]

    def bisect(lat, lon):
        out, ranges = 0, [[-180.0, 180.0], [-90.0, 90.0]]
        for i in range(5 * precision):
            r, v = ranges[i % 2], (lon, lat)[i % 2]
            mid = sum(r) / 2
            out, r[v < mid] = out * 2 + (v >= mid), mid
        return "".join("0123456789bcdefghjkmnpqrstuvwxyz"[out >> 5 * k & 31] for k in reversed(range(precision)))
    got = spark.createDataFrame(points, "a double, o double").select(geohash("a", "o", precision)).collect()
    assert [r[0] for r in got] == [bisect(*p) for p in points]


def test_blank_and_length_bounds(spark):
    texts = ODD + ["a" * n for n in range(11)] + ["é" * n for n in range(11)] + ["😀" * n for n in range(6)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for r in df.select("v", is_blank("v").alias("b"), not_blank("v").alias("n"),
                       F.col("v").rlike(r"\A\p{javaWhitespace}*\z").alias("old"),
                       utf16_length_between("v", 3, 8).alias("in"), utf16_length("v").between(3, 8).alias("want")).collect():
        assert r.b == (r.v is None or r.old) and r.n == (not r.b) and r["in"] == r.want


def test_cells_are_computed_once_per_row(spark, monkeypatch):
    seen = []
    write = catalog.Scratch.write
    monkeypatch.setattr(catalog.Scratch, "write", lambda self, df, name: (seen.append(name), write(self, df, name))[1])
    monkeypatch.setattr(catalog, "_RESPONSE_PATHS", {})
    assert catalog._geo_responses(spark, "/root/testdata/sf0.001").count() > 0
    assert "geo_cells" in seen  # stored before the filter on responses
