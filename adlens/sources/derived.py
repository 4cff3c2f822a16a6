"""The ad-log, app dictionary and geocoder responses derived from the driver's ``events`` table.

The source platform ships no log, so every registered query reads the ``events`` table
and derives an 85-column ad-log from it row by row (see FIXTURES.md section 3). The
derivation is written as SQL expressions that both Spark and DuckDB evaluate identically,
so the same log can be rebuilt inside oracle SQL; the operators under test are then
written with the DataFrame API on the Spark side and independently in SQL for the oracle.

All derived inputs grow with ``events``: one log row, one raw line and one dictionary line
per event; one geocoder response per distinct geohash cell of the log.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S

E = "event_id"
U = "user_id"


def session_key(spark: SparkSession) -> str:
    """Identifies the running application: derived inputs are written once per application."""
    return spark.sparkContext.applicationId


def _s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


# Per-column derivation (name -> portable SQL over events). Columns not listed are '' / 0 / 0.0.
_DERIVED: dict[str, str] = {
    "sessionid": f"concat('s', {_s(E)})",
    "adorderid": f"CAST({E} % 11 AS INT)",
    "adplatformproviderid": f"CAST(100000 + {U} % 9 AS INT)",
    "requestmode": f"CAST({E} % 4 AS INT)",
    "processnode": f"CAST(CAST(floor({E} / 4) AS BIGINT) % 5 AS INT)",
    "iseffective": f"CASE WHEN {E} % 7 <> 0 THEN 1 ELSE 0 END",
    "isbilling": f"CASE WHEN {E} % 5 <> 0 THEN 1 ELSE 0 END",
    "isbid": f"CASE WHEN {E} % 3 <> 0 THEN 1 ELSE 0 END",
    "iswin": f"CAST({E} % 2 AS INT)",
    "winprice": "coalesce(value, CAST(0 AS DOUBLE))",
    "adpayment": "coalesce(value, CAST(0 AS DOUBLE)) * 2",
    "adspacetype": f"CAST({E} % 13 AS INT)",
    "adspacetypename": (
        f"CASE {E} % 10 WHEN 0 THEN '' WHEN 1 THEN ' ' WHEN 2 THEN CAST(NULL AS STRING) "
        "ELSE 'banner' END"
    ),
    "client": f"CAST({U} % 5 AS INT)",
    "devicetype": f"CAST({U} % 4 AS INT)",
    "networkmannername": (
        f"CASE {E} % 6 WHEN 0 THEN 'Wifi' WHEN 1 THEN '4G' WHEN 2 THEN '3G' WHEN 3 THEN '2G' "
        "WHEN 4 THEN '未知' ELSE 'WIFI' END"
    ),
    "ispname": (
        f"CASE {U} % 5 WHEN 0 THEN '移动' WHEN 1 THEN '联通' WHEN 2 THEN '电信' "
        "WHEN 3 THEN '未知' ELSE '' END"
    ),
    "provincename": f"CASE WHEN {U} % 8 = 7 THEN '' ELSE concat('P', {_s(f'{U} % 8')}) END",
    "cityname": f"CASE WHEN {U} % 16 = 5 THEN '' ELSE concat('C', {_s(f'{U} % 16')}) END",
    "appname": f"CASE WHEN {E} % 3 = 0 THEN '' ELSE concat('app', {_s(f'{E} % 17')}) END",
    "appid": f"concat('com.app.', {_s(f'{E} % 23')})",
    "keywords": (
        f"concat(coalesce(event_type, ''), '|ab|kw', {_s(f'{E} % 19')}, "
        f"'|averyverylongkeyword|drama|kw', "
        f"{_s(f'CASE WHEN {E} % 2 = 0 THEN {E} % 19 ELSE {E} % 13 END')}, "
        f"CASE WHEN {E} % 4 = 0 THEN '|电视剧' ELSE '|言情剧' END)"
    ),
    "long": f"CAST(70 + CAST({E} % 700 AS DOUBLE) / CAST(10 AS DOUBLE) AS STRING)",
    "lat": (
        f"CASE WHEN {E} % 9 = 0 THEN 'bad' "
        f"ELSE CAST(CAST({E} % 560 AS DOUBLE) / CAST(10 AS DOUBLE) AS STRING) END"
    ),
    "imei": f"CASE WHEN {E} % 4 = 0 THEN '' ELSE concat('i', {_s(U)}) END",
    "mac": f"CASE WHEN {E} % 5 = 0 THEN concat('m', {_s(f'CAST(floor({U} / 3) AS BIGINT)')}) ELSE '' END",
    "idfa": f"CASE WHEN {E} % 28 = 8 THEN concat('f', {_s(U)}) ELSE '' END",
    "openudid": f"CASE WHEN {E} % 28 = 12 THEN concat('o', {_s(U)}) ELSE '' END",
    "androidid": f"CASE WHEN {E} % 4 = 0 AND {E} % 7 <> 0 THEN concat('a', {_s(U)}) ELSE '' END",
    "imeimd5": f"CASE WHEN {E} % 56 = 28 THEN md5(concat('i', {_s(U)})) ELSE '' END",
    "androididmd5": f"CASE WHEN {E} % 8 = 4 AND {E} % 7 <> 0 THEN concat('a', {_s(U)}) ELSE '' END",
    "imeisha1": f"CASE WHEN {E} % 168 = 0 THEN sha1(concat('i', {_s(U)})) ELSE '' END",
    "macsha1": (
        f"CASE WHEN {E} % 10 = 5 THEN sha1(concat('m', {_s(f'CAST(floor({U} / 3) AS BIGINT)')})) "
        "ELSE '' END"
    ),
    "idfasha1": f"CASE WHEN {E} % 28 = 8 THEN sha1(concat('f', {_s(U)})) ELSE '' END",
    "channelid": _s(f"100000 + {U} % 9"),
}

_DEFAULTS = {"S": "''", "I": "CAST(0 AS INT)", "D": "CAST(0 AS DOUBLE)"}


def derived_log_exprs() -> list[tuple[str, str]]:
    """(column, SQL expression over events) for all 85 log columns, in file order."""
    out = []
    for name, kind in S.LOG_COLUMNS:
        expr = _DERIVED.get(name, _DEFAULTS[kind])
        if kind == "D" and name in _DERIVED:
            expr = f"CAST({expr} AS DOUBLE)"
        out.append((name, expr))
    return out


def derived_log_sql(source: str = "events") -> str:
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in derived_log_exprs())
    return f"SELECT\n  {cols}\nFROM {source}"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table; dealt into ``adlens.events.partitions`` parts if that is set (the
    benchmark's tables are one row group each)."""
    events = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    parts = spark.conf.get("adlens.events.partitions", None)
    return events.repartition(int(parts)) if parts else events


def input_key(spark: SparkSession, sf_dir: str) -> tuple:
    """Names what is derived from ``events``: the session, and path, size and time of every file of
    the table, so that a changed input is derived anew."""
    path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, "events.parquet"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (session_key(spark), *sorted((str(f.getPath()), f.getLen(), f.getModificationTime())
                                        for f in fs.listStatus(path)))


def derived_log_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 85-column typed ad-log computed on the fly from ``events``."""
    events = read_events(spark, sf_dir)
    return events.selectExpr(*[f"{expr} AS {name}" for name, expr in derived_log_exprs()])


_LOG_PATHS: dict[tuple, str] = {}


def log_table_path(spark: SparkSession, sf_dir: str) -> str:
    """The derived ad-log written once per session and state of ``events`` as Snappy Parquet in the
    scratch folder, the way the platform's jobs read the ETL output (a Parquet log table)."""
    from adlens.session import scratch_path

    key = input_key(spark, sf_dir)
    if key not in _LOG_PATHS:
        path = scratch_path(spark, "adlog")
        derived_log_frame(spark, sf_dir).write.option("compression", "snappy").parquet(path)
        _LOG_PATHS[key] = path
    return _LOG_PATHS[key]


def derived_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 85-column typed ad-log table (scan with pruning and filter pushdown)."""
    return spark.read.schema(S.LOG_SCHEMA).parquet(log_table_path(spark, sf_dir))


# ---------------------------------------------------------------------------
# Raw text lines (input of the ETL): the derived log rendered as comma-separated fields.
# ---------------------------------------------------------------------------
def _raw_field_exprs() -> list[str]:
    """String rendering of each field; numeric fields get lenient-cast edge cases."""
    fields = []
    for name, expr in derived_log_exprs():
        kind = dict(S.LOG_COLUMNS)[name]
        if name == "advertisersid":
            # Exercise the lenient int cast: sign, spaces, decimals, overflow, empty.
            fields.append(
                f"CASE {E} % 8 WHEN 0 THEN {_s(E)} WHEN 1 THEN concat('+', {_s(E)}) "
                f"WHEN 2 THEN concat(' ', {_s(E)}, ' ') WHEN 3 THEN concat({_s(E)}, '.0') "
                f"WHEN 4 THEN '' WHEN 5 THEN concat({_s(E)}, '99999999999') "
                f"WHEN 6 THEN concat('-', {_s(E)}) ELSE 'x1' END"
            )
        elif name == "adprice":
            # Exercise the lenient double cast: spaces, exponent, junk, inf.
            fields.append(
                f"CASE {E} % 6 WHEN 0 THEN {_s('value')} WHEN 1 THEN concat(' ', {_s('value')}, ' ') "
                f"WHEN 2 THEN concat({_s(f'{E} % 10')}, 'e2') WHEN 3 THEN 'abc' "
                f"WHEN 4 THEN 'inf' ELSE '' END"
            )
        elif kind == "S":
            fields.append(f"coalesce({expr}, '')")
        else:
            fields.append(_s(expr))
    return fields


def raw_line_sql(source: str = "events") -> str:
    """One text line per event; every 10th event lacks its last field, every 7th has extras."""
    full = "concat_ws(',', " + ", ".join(_raw_field_exprs()) + ")"
    return (
        f"SELECT line_no, CASE WHEN line_no % 10 = 9 THEN regexp_replace(full_line, ',[^,]*$', '') "
        f"WHEN line_no % 7 = 3 THEN concat(full_line, ',extra,') ELSE full_line END AS value "
        f"FROM (SELECT {E} AS line_no, {full} AS full_line FROM {source}) AS raw"
    )


def broken_line_sql(source: str = "events") -> str:
    """The raw lines with blank ones, comments and lines of a few fields among them."""
    return (f"SELECT line_no, CASE line_no % 50 WHEN 9 THEN '' WHEN 29 THEN '  ' WHEN 33 THEN concat('# event ', {_s('line_no')}) "
            f"WHEN 41 THEN substr(value, 1, 40) ELSE value END AS value FROM ({raw_line_sql(source)}) AS plain")


_RAW_PATHS: dict[tuple, str] = {}


def raw_log_path(spark: SparkSession, sf_dir: str) -> str:
    """Text files holding one raw line per event, written once per session and state of ``events``
    to the scratch folder (the way a raw log arrives: text files read by ``spark.read.text``)."""
    from adlens.session import scratch_path

    key = input_key(spark, sf_dir)
    if key not in _RAW_PATHS:
        events = read_events(spark, sf_dir)
        path = scratch_path(spark, "raw_log")
        spark.sql(raw_line_sql("{src}"), src=events).select("value").write.text(path)
        _RAW_PATHS[key] = path
    return _RAW_PATHS[key]


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` text lines of the raw log derived from ``events``."""
    return spark.read.text(raw_log_path(spark, sf_dir))


# ---------------------------------------------------------------------------
# App dictionary lines: whitespace-separated, key in field 4, name in field 1.
# ---------------------------------------------------------------------------
def app_dict_line_sql(source: str = "events") -> str:
    key = f"concat('com.app.', {_s(f'{E} % 12')})"
    name = f"concat('name', {_s(f'{E} % 12')}, '_', {_s(f'{E} % 5')})"
    return (
        f"SELECT {E} AS line_no, CASE "
        f"WHEN {E} % 10 = 3 THEN concat({_s(E)}, '\t', {name}, '\tx\ty') "
        f"WHEN {E} % 10 = 7 THEN concat({_s(E)}, '\t', {name}, '\tx\ty\t') "
        f"WHEN {E} % 10 = 5 THEN concat({_s(E)}, ' ', {name}, '  y ', {key}) "
        f"ELSE concat({_s(E)}, '\t', {name}, '\tx\ty\t', {key}, '\tz') END AS value "
        f"FROM {source}"
    )


def app_dict_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, sf_dir)
    return spark.sql(app_dict_line_sql("{src}"), src=events)


# ---------------------------------------------------------------------------
# Geocoder responses: one stored response per distinct geohash cell of the log,
# chosen by the last character of the cell so every parsing branch is reached.
# ---------------------------------------------------------------------------
def geo_response_expr(cell: str = "geohash6") -> str:
    """SQL (portable) for the stored JSON response of a cell; NULL = never geocoded."""
    k = f"ascii(substr({cell}, 6, 1)) % 7"
    area = f"substr({cell}, 1, 4)"
    return (
        f"CASE {k} "
        "WHEN 0 THEN CAST(NULL AS STRING) "
        "WHEN 1 THEN '{\"status\":\"0\",\"info\":\"INVALID\"}' "
        "WHEN 2 THEN concat('{\"status\":\"1\",\"regeocode\":{\"addressComponent\":{\"businessAreas\":["
        "{\"location\":\"1,2\",\"name\":\"A', " + area + ", '\",\"id\":\"1\"},"
        "{\"location\":\"1,2\",\"name\":\"B', " + cell + ", '\",\"id\":\"2\"},"
        "{\"location\":\"1,2\",\"name\":\"C', " + area + ", '\",\"id\":\"3\"}]}}}') "
        "WHEN 3 THEN '{\"status\":1,\"regeocode\":{\"addressComponent\":{\"businessAreas\":[[]]}}}' "
        "WHEN 4 THEN concat('{\"status\":\"1\",\"regeocode\":{\"addressComponent\":{\"businessAreas\":["
        "{\"name\":\"M', " + area + ", '\"},[],\"x\",{\"location\":\"1,2\",\"name\":\"N', " + cell + ", '\"}]}}}') "
        "WHEN 5 THEN '{\"status\":\"1\",\"regeocode\":' "
        "ELSE concat('{\"status\":\"1\",\"regeocode\":{\"addressComponent\":{\"businessAreas\":["
        "{\"name\":\"S', " + area + ", '\"},{\"id\":\"7\"}]}}}') END"
    )


def new_response_expr(cell: str = "geohash6", at: str = "at") -> str:
    """SQL (portable) for responses fetched later: for some cells none, for some an empty one, and
    of two for a cell the second one is newer."""
    k = f"ascii(substr({cell}, 5, 1)) % 4"
    return (f"CASE WHEN {k} = 0 THEN CAST(NULL AS STRING) "
            f"WHEN {k} = 1 AND {at} = 2 THEN '{{\"status\":\"0\"}}' "
            f"WHEN {k} = 2 AND {at} = 1 THEN '{{\"status\":\"1\",\"regeocode\":{{}}}}' "
            f"ELSE concat('{{\"status\":\"1\",\"regeocode\":{{\"addressComponent\":{{\"businessAreas\":["
            f"{{\"name\":\"', CASE WHEN {at} = 1 THEN 'Z' ELSE 'B' END, {cell}, '\"}}]}}}}}}') END")


def dirty_price_expr() -> str:
    """SQL (portable): ``winprice`` of the log with a rare NaN, Infinity or 2 ** 100."""
    h = "ascii(substr(sessionid, length(sessionid), 1)) + 10 * ascii(substr(sessionid, length(sessionid) - 1, 1))"
    return (f"CASE WHEN ({h}) % 97 = 5 AND length(cityname) % 2 = 0 THEN CAST('NaN' AS DOUBLE) "
            f"WHEN ({h}) % 89 = 7 AND length(cityname) % 2 = 0 THEN CAST('Infinity' AS DOUBLE) "
            f"WHEN ({h}) % 13 = 3 THEN CAST(1267650600228229401496703205376 AS DOUBLE) ELSE winprice END")


def placeholder_exprs() -> dict[str, str]:
    """SQL (portable): id columns of the log with values that stand on the rows of many people."""
    n = "CAST(substr(sessionid, 2) AS BIGINT)"
    return {"imei": f"CASE WHEN {n} % 9 = 4 THEN '000000000000000' ELSE imei END",
            "mac": f"CASE WHEN {n} % 31 = 7 THEN '02:00:00:00:00:00' ELSE mac END"}


def drift_exprs() -> dict[str, str]:
    """SQL (portable): the log's points moved by up to three cells east and two north."""
    n = "CAST(substr(sessionid, 2) AS BIGINT)"
    return {"long": f"{_s(f'TRY_CAST(long AS DOUBLE) + ({n} % 4) * CAST(0.011 AS DOUBLE)')}",
            "lat": f"{_s(f'TRY_CAST(lat AS DOUBLE) + ({n} % 3) * CAST(0.0055 AS DOUBLE)')}"}


def chain_edge_sql(source: str = "events") -> str:
    """Each event is tied to the next one unless that begins a new block of 500; the ids are
    scrambled by a multiplication modulo a prime above every event id."""
    scramble = "({}) * 48271 % 2147483647"
    return (f"SELECT {scramble.format(E)} AS src, {scramble.format(f'{E} + CASE WHEN {E} % 500 = 499 THEN 0 ELSE 1 END')} "
            f"AS dst FROM {source}")


# Stop words used with the derived log: the shipped list plus one ASCII word present in it.
FIXTURE_STOP_WORDS = S.DEFAULT_STOP_WORDS + ["drama"]
