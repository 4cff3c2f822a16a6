"""Session helpers: defaults for local runs and the shared checkpoint / scratch folder.

On a cluster the caller owns the session and names a shared, reliable folder in
``spark.checkpoint.dir``; we only read it. A local folder is created solely when none is
configured and the master is local (tests, local benchmarks); any other master without a
configured folder is an error, as its nodes would not see one another's files.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "adlens", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used by the library itself)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(LOCAL_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only when none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; master {sc.master} needs a folder that "
                               "the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="adlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written intermediate table."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


class Scratch:
    """Intermediate tables of one job, written under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def write(self, df: DataFrame, name: str) -> tuple[DataFrame, str]:
        """``df`` stored and read back, and where it lies."""
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def write_observed(self, df: DataFrame, name: str, value: Column) -> tuple[DataFrame, str, object]:
        """As ``write``, and an aggregate of the rows, taken while they are written (no job of its own)."""
        seen = Observation()
        out, path = self.write(df.observe(seen, value.alias("value")), name)
        return out, path, seen.get["value"]

    def drop(self, *paths: str) -> None:
        """Delete stored tables that nothing will read again."""
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
