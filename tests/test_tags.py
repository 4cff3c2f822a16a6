"""Tag families against the goldens written next to the profile jobs."""

from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators.merge import merge_tags
from adlens.operators.tags import TagContext, register_family, row_tags, FAMILIES
from adlens.sources.dictionaries import stopwords_frame


def _log(spark, rows):
    """Log rows given as dicts; unspecified columns take '' / 0 / 0.0."""
    defaults = {"S": "", "I": 0, "D": 0.0}
    data = [tuple(r.get(n, defaults[k]) for n, k in S.LOG_COLUMNS) for r in rows]
    return spark.createDataFrame(data, S.LOG_SCHEMA)


def _tags(df, families, ctx=None, key="sessionid"):
    ctx = ctx or TagContext()
    return sorted((r[key], r["tag"]) for r in row_tags(df, families, ctx, [key]).collect())


def test_row_tag_golden(spark):
    df = _log(spark, [
        {"sessionid": "r1", "client": 1, "networkmannername": "Wifi", "ispname": "未知", "adspacetype": 12,
         "adspacetypename": "banner", "adplatformproviderid": 100018},
        {"sessionid": "r2", "client": 1, "networkmannername": "Wifi", "ispname": "", "adspacetype": 9,
         "adspacetypename": "x", "adplatformproviderid": 100018},
    ])
    got = _tags(df, ["ad", "device"])
    assert got == sorted([("r1", "LC12"), ("r1", "CN100018"), ("r1", "D00010001"), ("r1", "D00020001"),
                          ("r1", "D00030004"), ("r2", "LC09"), ("r2", "CN100018"), ("r2", "D00010001"),
                          ("r2", "D00020001"), ("r2", "D00030004")])


def test_ad_name_tag_only_when_blank(spark):
    df = _log(spark, [{"sessionid": "a", "adspacetype": 0, "adspacetypename": ""},
                      {"sessionid": "b", "adspacetype": -1, "adspacetypename": " "},
                      {"sessionid": "c", "adspacetype": 10, "adspacetypename": None},
                      {"sessionid": "d", "adspacetype": 3, "adspacetypename": "name"}])
    got = [t for t in _tags(df, ["ad"]) if not t[1].startswith("CN")]
    assert got == [("a", "LN"), ("b", "LN "), ("c", "LC10"), ("c", "LNnull"), ("d", "LC03")]
    present = [t for t in _tags(df, ["ad"], TagContext(ad_name_mode="present")) if t[1].startswith("LN")]
    assert present == [("d", "LNname")]


def test_location_and_app(spark):
    df = _log(spark, [{"sessionid": "a", "provincename": "广东省", "cityname": "未知", "appname": "", "appid": "k1"},
                      {"sessionid": "b", "provincename": " ", "cityname": "", "appname": "", "appid": "zz"},
                      {"sessionid": "c", "appname": "爱奇艺", "appid": "k1"}])
    app_dict = spark.createDataFrame([("k1", "dictname")], "appid string, appname_dict string")
    got = _tags(df, ["location", "app"], TagContext(app_dict=app_dict))
    assert got == sorted([("a", "ZP广东省"), ("a", "ZC未知"), ("a", "APPdictname"), ("b", "APP其他"),
                          ("c", "APP爱奇艺")])


def test_keyword_repeats_count_twice(spark):
    df = _log(spark, [{"sessionid": "a", "imei": "x", "keywords": "女流氓|女流氓|ab|电视剧|averyverylongword"},
                      {"sessionid": "b", "imei": "x", "keywords": None}])
    for stop in (list(S.DEFAULT_STOP_WORDS), stopwords_frame(spark, S.DEFAULT_STOP_WORDS)):
        long = row_tags(df.withColumn("user", F.lit("u")), ["keyword"], TagContext(stop_words=stop), ["user"])
        w = {r["tag"]: r["weight"] for r in merge_tags(long, "user").collect()}
        assert w == {"K女流氓": 2}


def test_business_tags(spark):
    df = _log(spark, [{"sessionid": "a", "long": "116.310003", "lat": "39.991957"},
                      {"sessionid": "b", "long": "10", "lat": "10"}])
    from adlens.operators.geo import with_cell
    cell = with_cell(df).filter("sessionid = 'a'").first()["geohash6"]
    dim = spark.createDataFrame([(cell, "万泉河,中关村,")], "geohash6 string, business_areas string")
    got = _tags(df, ["business"], TagContext(geo_dim=dim))
    assert got == [("a", "万泉河"), ("a", "中关村")]


def test_registry_extension(spark):
    def family_title(df, ctx):
        return df, F.array(F.struct(F.lit("title").alias("kind"), F.concat(F.lit("T"), F.col("title")).alias("tag")))
    register_family("title", family_title)
    try:
        df = _log(spark, [{"sessionid": "a", "title": "news"}])
        assert _tags(df, ["title"]) == [("a", "Tnews")]
    finally:
        FAMILIES.pop("title")
