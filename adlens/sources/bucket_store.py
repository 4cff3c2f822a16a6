"""Versioned tables in hash buckets, for results that are kept up to date.

A store is a folder of versions ``v=<n>/bucket=<b>/``. A version is written by one Spark job and
counts once its success marker is there, so a job that dies half way leaves the store as it was
and may run again. Readers name the versions and buckets they need; the others are pruned before any file is
opened. Only folder names reach the driver: at most versions x buckets of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BUCKETS = 64


class BucketStore:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.schema = T.StructType.fromDDL(schema) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(schema)

    def _fs(self, path: str):
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), target

    def _numbers(self, path: str, name: str) -> list[int]:
        fs, target = self._fs(path)
        if not fs.exists(target):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory()]
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{name}="))

    def _done(self, version: int) -> bool:
        fs, marker = self._fs(f"{self.path}/v={version}/_SUCCESS")
        return fs.exists(marker)

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        return [v for v in self._numbers(self.path, "v") if self._done(v)]

    def held(self, version: int) -> list[int]:
        """Buckets that a version has rows in."""
        return self._numbers(f"{self.path}/v={version}", "bucket")

    def newest(self) -> dict[int, int]:
        """Bucket -> the last version that wrote it."""
        return {b: v for v in self.versions() for b in self.held(v)}

    def bucket(self, key: str | Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def write(self, df: DataFrame, version: int) -> None:
        """``df`` as a version, replacing what an earlier attempt left there. Rows are dealt by bucket and row,
        so that a hot key's bucket is several files."""
        columns = [f.name for f in self.schema.fields]
        out = df.select(*columns).withColumn("bucket", self.bucket(self.key))
        out.repartition("bucket", F.pmod(F.xxhash64(*columns), F.lit(4))).write.mode("overwrite") \
           .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/v={version}")

    def read(self, versions: Iterable[int], buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of ``versions`` with their ``v`` and ``bucket``; of some buckets only, if named."""
        schema = T.StructType([*self.schema.fields, T.StructField("v", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        paths = [f"{self.path}/v={v}" for v in versions]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)
        return rows if buckets is None else rows.filter(F.col("bucket").isin(list(buckets)))

    def read_newest(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Each bucket as the last version that wrote it has it."""
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.path}/v={v}/bucket={b}" for b, v in self.newest().items() if wanted is None or b in wanted]
        schema = T.StructType([*self.schema.fields, T.StructField("v", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    def drop(self, *versions: int) -> None:
        for v in versions:
            fs, target = self._fs(f"{self.path}/v={v}")
            fs.delete(target, True)

    def vacuum(self) -> None:
        """Delete bucket folders that a later version has replaced."""
        newest = self.newest()
        for v in self.versions():
            for b in self.held(v):
                if newest[b] != v:
                    fs, target = self._fs(f"{self.path}/v={v}/bucket={b}")
                    fs.delete(target, True)
