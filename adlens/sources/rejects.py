"""S1 / P1 with its rejected lines kept: one scan of the raw log, good and rejected rows beside each other.

The platform drops a line of fewer than 85 fields without a trace. Here every line gets a verdict and one
job writes all of them: ``verdict=ok`` holds the typed log (``read_log`` reads it), the other
folders hold the line as it came, its number of fields and the file and block it was read from, so that a
broken shipment can be found and sent again. Lines are counted while they are written.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import is_blank
from adlens.sources.rawlog import type_log
from adlens.sources.sinks import read_log

OK = "ok"
# blank: nothing but white space; no_fields: no comma at all (a header, a comment); few_fields: cut off or damaged.
REASONS = ("blank", "no_fields", "few_fields")
REJECTED = "verdict string, line string, n_fields int, file string, block_start bigint, block_length bigint"


def verdict(line: Column, fields: Column) -> Column:
    """``ok`` or the reason why the line is no log row."""
    n = F.size(fields)
    return (F.when(n >= S.N_LOG_FIELDS, OK).when(is_blank(line), "blank")
             .when(n < 2, "no_fields").otherwise("few_fields"))


@dataclass(frozen=True)
class Ingest:
    """Where the rows of one run lie, and how many lines got which verdict."""
    spark: SparkSession
    path: str
    counts: dict[str, int]

    @property
    def lines(self) -> int:
        return sum(self.counts.values())

    def log(self) -> DataFrame:
        if not self.counts[OK]:
            return self.spark.createDataFrame([], S.LOG_SCHEMA)
        return read_log(self.spark, f"{self.path}/verdict={OK}")

    def rejected(self) -> DataFrame:
        """``verdict, line, n_fields, file, block_start, block_length``; only folders of rejected lines are read."""
        folders = [f"{self.path}/verdict={r}" for r in REASONS if self.counts[r]]
        if not folders:
            return self.spark.createDataFrame([], REJECTED)
        return self.spark.read.schema(REJECTED).option("basePath", self.path).parquet(*folders).select(
            *[part.split()[0] for part in REJECTED.split(", ")])


@contextmanager
def _open_writers(spark: SparkSession, n: int):
    """A task keeps one file open per verdict instead of sorting its rows by verdict."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def ingest_with_rejects(spark: SparkSession, raw_path: str, out_path: str, mode: str = "errorifexists") -> Ingest:
    """Type the raw log under ``raw_path`` and keep what cannot be typed; one scan, one job, no exchange.

    Good rows have their 85 columns and no ``line``; rejected ones the other way round. Every input line is in
    exactly one folder.
    """
    raw = spark.read.text(raw_path).select(
        "value", F.split("value", ",", -1).alias("fields"), F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"), F.col("_metadata.file_block_length").alias("__length"))
    judged = raw.withColumn("verdict", verdict(F.col("value"), F.col("fields")))
    bad = F.col("verdict") != OK
    keep = {"line": F.col("value"), "n_fields": F.size("fields"), "file": F.col("__file"),
            "block_start": F.col("__start"), "block_length": F.col("__length")}
    judged = judged.withColumns({n: F.when(bad, c) for n, c in keep.items()})
    # Of a rejected line no field is bound: it has no array, and so no columns.
    judged = judged.withColumn("fields", F.when(~bad, F.col("fields")))
    seen = Observation()
    typed = type_log(judged, keep=["verdict", *keep])
    nothing = [F.when(F.col("line").isNull(), F.col(f"`{c}`")).alias(c) for c, _ in S.LOG_COLUMNS]
    out = typed.select("verdict", *keep, *nothing).observe(
        seen, *[F.count_if(F.col("verdict") == v).alias(v) for v in (OK, *REASONS)])
    with _open_writers(spark, len(REASONS) + 1):
        out.write.mode(mode).option("partitionOverwriteMode", "static").option("compression", "snappy") \
           .partitionBy("verdict").parquet(out_path)
    counts = seen.get
    return Ingest(spark, out_path.rstrip("/"), {v: int(counts[v]) for v in (OK, *REASONS)})
