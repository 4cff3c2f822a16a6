"""Property tests: weight conservation and the lenient int cast against a Java model."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlens.operators.tags import TagContext, row_tags, FAMILIES_V2
from adlens.operators.merge import merge_tags
from adlens.functions.scalar import lenient_int
from adlens.sources.derived import derived_log
from adlens.operators.identity import user_key
from fixtures_small import SF_SMALL


def test_tag_weights_sum_to_exploded_rows(spark):
    log = derived_log(spark, SF_SMALL).withColumn("user_key", user_key())
    long = row_tags(log, FAMILIES_V2, TagContext(stop_words=["drama"]), ["user_key"])
    merged = merge_tags(long, "user_key")
    assert merged.agg(F.sum("weight")).first()[0] == long.count()
    assert merged.groupBy("user_key", "kind", "tag").count().filter("count > 1").count() == 0


def _java_parse_int(s):
    import re
    if s is None or not re.fullmatch(r"[+-]?[0-9]+", s):
        return 0
    v = int(s)
    return v if -2**31 <= v < 2**31 else 0


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="+-0123456789 .xe", max_size=12),
                          st.integers(-2**33, 2**33).map(str)), min_size=50, max_size=200))
def test_lenient_int_matches_java_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(lenient_int("v")).collect()]
    assert got == [_java_parse_int(v) for v in values]


def _java_parse_double(s):
    """Java Double.parseDouble on strings over [0-9.+-e ]: surrounding whitespace allowed,
    optional sign, decimal digits with an optional point and exponent; anything else fails."""
    import re
    if s is None:
        return 0.0
    t = s.strip(" ")
    if not re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?", t):
        return 0.0
    return float(t)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="0123456789.+-e ", max_size=10),
                          st.floats(allow_nan=False, allow_infinity=False).map(repr)),
                min_size=50, max_size=200))
def test_lenient_double_matches_java_model(spark, values):
    from adlens.functions.scalar import lenient_double
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(lenient_double("v")).collect()]
    assert got == [_java_parse_double(v) for v in values]
