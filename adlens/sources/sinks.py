"""Sources and sinks of the log and the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S


# --- S3 / S4: typed log as Parquet ------------------------------------------
def write_log(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Snappy Parquet; the default mode refuses to overwrite an existing output."""
    df.write.mode(mode).option("compression", "snappy").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The ad-log with its declared schema (no inference, pruning and pushdown apply)."""
    return spark.read.schema(S.LOG_SCHEMA).parquet(path)


# --- S7: partitioned JSON ------------------------------------------------------
def write_partitioned_json(df: DataFrame, partition_cols: list[str], path: str,
                           mode: str = "errorifexists") -> None:
    """One folder per partition value; the JSON body holds the other columns.

    Empty strings and nulls both land in the default partition and read back as null.
    """
    df.write.mode(mode).partitionBy(*partition_cols).json(path)


# --- S8: text report lines -----------------------------------------------------
def _java_str(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("null"))


def report_key(key_cols: list[str]) -> Column:
    """A single key prints as itself; several print as a tuple ``(a,b)``."""
    parts = [_java_str(F.col(k)) for k in key_cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat(F.lit("("), F.concat_ws(",", *parts), F.lit(")"))


def report_lines(df: DataFrame, key_cols: list[str],
                 metric_cols: list[str] = S.KPI_NAMES) -> DataFrame:
    """``key,m1,...,m9`` with every metric printed as a double (``1.0``, ``0.5``)."""
    metrics = [_java_str(F.col(m).cast("double")) for m in metric_cols]
    return df.select(F.concat_ws(",", report_key(key_cols), *metrics).alias("value"))


def write_text_report(df: DataFrame, key_cols: list[str], path: str,
                      mode: str = "errorifexists") -> None:
    report_lines(df, key_cols).write.mode(mode).text(path)


# --- S9: JDBC append -------------------------------------------------------------
def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to a JDBC table; the caller supplies driver, user and password."""
    df.write.mode("append").jdbc(url, table, properties=properties)


# --- S10: profiles ------------------------------------------------------------------
def write_profiles(df: DataFrame, path: str, dt: str) -> None:
    """Profiles partitioned by day; re-running one day replaces only that day."""
    (df.withColumn("dt", F.lit(dt)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path))
