"""The library's expressions as SQL functions, for users who write ``spark.sql`` only.

``register_sql_functions(spark)`` creates temporary SQL functions. Their bodies are SQL that Spark inlines
into the caller's plan, so they cost the same as the Column forms and no Python runs. Tag families return
``ARRAY<STRUCT<kind, tag>>``. Spark takes no SQL function as a generator's argument, so rows are made of a
subquery's column::

    SELECT sessionid, inline(tags) FROM (
        SELECT sessionid, adlens_location_tags(provincename, cityname) AS tags FROM log)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from adlens import schema as S
from adlens.functions import scalar
from adlens.functions.geohash import _CONV_DIGITS, GEOHASH_ALPHABET

TAGS = "ARRAY<STRUCT<kind: STRING, tag: STRING>>"


@dataclass(frozen=True)
class SqlFunction:
    name: str
    parameters: str
    returns: str
    body: str

    def ddl(self) -> str:
        return f"CREATE OR REPLACE TEMPORARY FUNCTION {self.name}({self.parameters}) RETURNS {self.returns} RETURN {self.body}"


def _text(value) -> str:
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _regex(pattern: str) -> str:
    return f"r'{pattern}'"


def _codes(value: str, codes: dict, default: str) -> str:
    cases = " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in codes.items())
    return f"CASE {value} {cases} ELSE {_text(default)} END"


def _entry(kind: str, tag: str) -> str:
    return f"named_struct('kind', {_text(kind)}, 'tag', {tag})"


def _present(*entries: str) -> str:
    return f"filter(array({', '.join(entries)}), e -> e IS NOT NULL)"


def _cell_index(value: str, low: float, high: float) -> str:
    cells = 1 << 15
    return (f"least(greatest(CAST(floor(({value} - {low}D) / {high - low}D * {float(cells)}D) AS BIGINT), 0L), "
            f"{cells - 1}L)")


def _bits(index: str) -> str:
    return f"split(lpad(conv(CAST({index} AS STRING), 10, 2), 15, '0'), '', -1)"


def sql_functions(stop_words: list[str] | None = None, name_mode: str = "blank") -> list[SqlFunction]:
    """All functions, those that others use first. ``stop_words`` and ``name_mode`` as in ``TagContext``."""
    stop = S.DEFAULT_STOP_WORDS if stop_words is None else stop_words
    box = S.GEO_BOX
    blank = "adlens_is_blank"
    unwanted = f" AND NOT (w IN ({', '.join(map(_text, stop))}))" if stop else ""
    space = "coalesce(space_type, 0)"
    named = f"{blank}(space_name)" if name_mode == "blank" else f"NOT {blank}(space_name)"
    ad = _present(
        f"CASE WHEN {space} > 9 THEN {_entry('ad', f'concat({_text(S.TAG_PREFIX_AD_SPACE)}, CAST({space} AS STRING))')} "
        f"WHEN {space} > 0 THEN {_entry('ad', f'concat({_text(S.TAG_PREFIX_AD_SPACE + str(0))}, CAST({space} AS STRING))')} END",
        "CASE WHEN " + named + " THEN " + _entry(
            "ad", f"concat({_text(S.TAG_PREFIX_AD_NAME)}, coalesce(space_name, 'null'))") + " END",
        _entry("ad", f"concat({_text(S.TAG_PREFIX_CHANNEL)}, CAST(coalesce(channel, 0) AS STRING))"))
    app = (f"array({_entry('app', 'concat(' + _text(S.TAG_PREFIX_APP) + ', CASE WHEN ' + blank + '(appname) '
           + 'THEN coalesce(dict_name, ' + _text(S.OTHER) + ') ELSE appname END)')})")
    device = ", ".join(_entry("device", c) for c in (
        _codes("coalesce(client, 0)", S.OS_TAGS, S.OS_TAG_DEFAULT), _codes("network", S.NETWORK_TAGS, S.NETWORK_TAG_DEFAULT),
        _codes("carrier", S.CARRIER_TAGS, S.CARRIER_TAG_DEFAULT)))
    location = _present(*[
        f"CASE WHEN NOT {blank}({c}) THEN {_entry('location', f'concat({_text(p)}, {c})')} END"
        for p, c in ((S.TAG_PREFIX_PROVINCE, "province"), (S.TAG_PREFIX_CITY, "city"))])
    keyword = (f"transform(filter(coalesce(split(keywords, '[|]', -1), CAST(array() AS ARRAY<STRING>)), "
               f"w -> octet_length(encode(w, 'UTF-16BE')) BETWEEN {2 * S.KEYWORD_MIN_LEN} AND {2 * S.KEYWORD_MAX_LEN}{unwanted}), "
               f"w -> {_entry('keyword', f'concat({_text(S.TAG_PREFIX_KEYWORD)}, w)')})")
    areas = "from_json(response, 'status STRING, regeocode STRUCT<addressComponent: STRUCT<businessAreas: ARRAY<STRING>>>')"
    listed = f"{areas}.regeocode.addressComponent.businessAreas"
    names = f"transform(filter({listed}, x -> startswith(x, '{{')), x -> coalesce(get_json_object(x, '$.name'), 'null'))"
    geohash = (f"translate(lpad(conv(array_join(zip_with({_bits(_cell_index('lon', -180.0, 180.0))}, "
               f"{_bits(_cell_index('lat', -90.0, 90.0))}, (a, b) -> concat(a, b)), ''), 2, 32), {S.GEOHASH_CHARS}, '0'), "
               f"'{_CONV_DIGITS}', '{GEOHASH_ALPHABET}')")
    return [
        SqlFunction(blank, "v STRING", "BOOLEAN", f"v IS NULL OR v RLIKE {_regex(scalar._BLANK_RE)}"),
        SqlFunction("adlens_lenient_int", "v STRING", "INT",
                    f"coalesce(CASE WHEN v RLIKE {_regex(scalar._JAVA_INT_RE)} THEN try_cast(v AS INT) END, 0)"),
        SqlFunction("adlens_lenient_double", "v STRING", "DOUBLE",
                    f"coalesce(CASE WHEN NOT (v RLIKE {_regex(scalar._SPARK_ONLY_SPECIALS_RE)} AND NOT v RLIKE "
                    f"{_regex(scalar._JAVA_SPECIALS_RE)}) THEN try_cast(v AS DOUBLE) END, 0D)"),
        SqlFunction("adlens_in_geo_box", "lon STRING, lat STRING", "BOOLEAN",
                    f"adlens_lenient_double(lon) BETWEEN {box['long_min']}D AND {box['long_max']}D AND "
                    f"adlens_lenient_double(lat) BETWEEN {box['lat_min']}D AND {box['lat_max']}D"),
        SqlFunction("adlens_geohash6", "lat DOUBLE, lon DOUBLE", "STRING",
                    f"CASE WHEN lat IS NOT NULL AND lon IS NOT NULL THEN {geohash} END"),
        SqlFunction("adlens_business_areas", "response STRING", "STRING",
                    f"CASE WHEN adlens_lenient_int({areas}.status) = 0 OR {listed} IS NULL THEN '' "
                    f"ELSE array_join({names}, ',') END"),
        SqlFunction("adlens_ad_tags", "space_type INT, space_name STRING, channel INT", TAGS, ad),
        SqlFunction("adlens_app_tags", "appname STRING, dict_name STRING", TAGS, app),
        SqlFunction("adlens_device_tags", "client INT, network STRING, carrier STRING", TAGS, f"array({device})"),
        SqlFunction("adlens_location_tags", "province STRING, city STRING", TAGS, location),
        SqlFunction("adlens_keyword_tags", "keywords STRING", TAGS, keyword),
        SqlFunction("adlens_business_tags", "areas STRING", TAGS,
                    f"transform(CASE WHEN {blank}(areas) OR regexp_replace(areas, ',+$', '') = '' THEN CAST(array() AS ARRAY<STRING>) "
                    f"ELSE split(regexp_replace(areas, ',+$', ''), ',', -1) END, n -> {_entry('business', 'n')})"),
    ]


def register_sql_functions(spark: SparkSession, stop_words: list[str] | None = None, name_mode: str = "blank") -> list[str]:
    """Create the functions in this session; registering again replaces them. Returns their names."""
    functions = sql_functions(stop_words, name_mode)
    for function in functions:
        spark.sql(function.ddl())
    return [f.name for f in functions]
