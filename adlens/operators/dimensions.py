"""Dimension lookups: joining a small dimension table to the big log.

A dimension is broadcast only behind a size check: its rows and bytes are measured first
(two numbers to the driver, one job) and it is broadcast when both are within the bounds;
otherwise the join is a sort-merge join on the key, where AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens import schema as S
from adlens.functions.scalar import is_blank

# Largest dimension we broadcast: both bounds must hold (rows, and measured bytes).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


_FIXED_WIDTH = {T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
                T.DateType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
                T.TimestampNTZType: 8, T.DecimalType: 16}


def measure(dim: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``dim`` in one job: strings count their UTF-8 bytes, other
    atomic columns their fixed width, nested columns their JSON text length."""
    widths = []
    for f in dim.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, T.BinaryType):
            widths.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            widths.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            widths.append(F.lit(_FIXED_WIDTH.get(type(f.dataType), 16)))
    row_bytes = sum(widths[1:], widths[0]) if widths else F.lit(0)
    r = dim.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes.cast("bigint")).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def is_broadcastable(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                     max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    rows, size = measure(dim)
    return rows <= max_rows and size <= max_bytes


def join_dimension(big: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """Join ``dim`` to ``big``; broadcast it only when its size is proven small.

    Above the bound the join is hinted as a sort-merge join, so a misestimated plan can
    never broadcast the log side instead; AQE still splits skewed keys of that join. The
    measurement is a job of its own, so pass a stored table rather than a computed one.
    """
    if is_broadcastable(dim, max_broadcast_rows, max_broadcast_bytes):
        dim = F.broadcast(dim)
    else:
        dim = dim.hint("merge")
    return big.join(dim, on, how)


def app_name_column(appname: Column, dict_name: Column, default: str) -> Column:
    """Keep a non-blank app name, else the dictionary name, else the default."""
    return F.when(is_blank(appname), F.coalesce(dict_name, F.lit(default))).otherwise(appname)


def resolve_app_name(df: DataFrame, app_dict: DataFrame, default: str = S.APP_REPORT_DEFAULT,
                     out_col: str = "app", **join_kw) -> DataFrame:
    """Blank-guarded dictionary lookup with a default; ``app_dict`` is (appid, appname_dict).

    The dictionary must be unique on ``appid`` (``parse_app_dict`` guarantees it), so the
    left join keeps exactly one output row per log row.
    """
    d = app_dict.select(F.col("appid").alias("__dict_appid"), F.col("appname_dict"))
    joined = join_dimension(df, d, F.col("appid") == F.col("__dict_appid"), "left", **join_kw)
    return joined.withColumn(
        out_col, app_name_column(F.col("appname"), F.col("appname_dict"), default)
    ).drop("__dict_appid", "appname_dict")
