"""Raw comma-separated log lines -> 85 typed columns (P1 is read -> type -> write).

The raw format has no quoting or escaping, so lines are split on every comma (keeping
trailing empty fields) instead of going through the CSV reader. Lines with fewer than 85
fields are dropped; extra fields are ignored. The whole pipeline is one narrow stage:
``FileScan text -> Project(split) -> Filter(size) -> Project(85 casts)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import lenient_double, lenient_int


def split_raw(lines: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """(fields array) for lines with at least 85 comma-separated fields."""
    keep = keep or []
    return (lines.select(*keep, F.split(F.col(value_col), ",", -1).alias("fields"))
                 .filter(F.size("fields") >= S.N_LOG_FIELDS))


def read_raw_log(spark: SparkSession, path: str) -> DataFrame:
    return split_raw(spark.read.text(path))


def type_log(fields_df: DataFrame, fields_col: str = "fields", keep: list[str] | None = None) -> DataFrame:
    """Bind the 85 positions to the log schema with lenient int / double casts."""
    f = F.col(fields_col)
    cols = []
    for i, (name, kind) in enumerate(S.LOG_COLUMNS):
        v = f[i]
        if kind == "I":
            v = lenient_int(v)
        elif kind == "D":
            v = lenient_double(v)
        cols.append(v.alias(name))
    return fields_df.select(*(keep or []), *cols)


def ingest_raw_log(spark: SparkSession, path: str) -> DataFrame:
    """P1 without the write: typed log from a raw text path."""
    return type_log(read_raw_log(spark, path))
