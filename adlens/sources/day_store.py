"""Sums kept up to date by day: mergeable day parts and their total, in hash buckets.

``days`` holds the sums of each day's rows, ``total`` the sum over all days, both in buckets of one key column.
Putting a day sums its rows, subtracts what that day had before (nothing, if it is new) and adds the
difference to the totals of the buckets in which there is one; other buckets are neither read nor
written. Values are whole numbers or decimals, so a replaced day leaves exactly what a rebuild from all rows
would give; a group whose ``alive`` value comes to zero is gone.

A put writes the day first, then the totals with the day's version in their rows. Should it die in
between, the next put of any day sees that the totals lack a version and sums its buckets anew from the days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import Scratch
from adlens.sources.bucket_store import DEFAULT_BUCKETS, BucketStore


class DayStore:
    """``values`` summed by ``keys``, in buckets of ``bucket_key`` (one of the keys, or computed from them alone)."""

    schema: str
    keys: list[str]
    values: list[str]
    bucket_key: str
    alive: str

    def __init__(self, spark: SparkSession, path: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.total = BucketStore(spark, f"{path}/total", self.schema, self.bucket_key, buckets)
        self.columns = [*self.keys, *self.values]
        self.merged_buckets: set[int] = set()

    def day(self, dt: str) -> BucketStore:
        """The parts of one day; its last version counts."""
        if not dt.isalnum():
            raise ValueError(f"a day is letters and digits only, not {dt!r}")
        return BucketStore(self.spark, f"{self.path}/days/dt={dt}", self.schema, self.bucket_key, self.buckets)

    def days(self) -> list[str]:
        fs, target = self.total._fs(f"{self.path}/days")
        if not fs.exists(target):
            return []
        names = sorted(s.getPath().getName().partition("=")[2] for s in fs.listStatus(target))
        return [dt for dt in names if self.day(dt).versions()]

    def _day_rows(self, dt: str, buckets=None) -> DataFrame:
        store = self.day(dt)
        return store.read(store.versions()[-1:], buckets).select(*self.columns, "bucket")

    def _sum(self, rows: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in self.total.schema.fields}
        sums = [F.sum(v).cast(kinds[v]).alias(v) for v in self.values]
        return rows.groupBy(*self.keys).agg(*sums).filter(F.col(self.alive) != 0)

    def _minus(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.keys, *[(-F.col(v)).alias(v) for v in self.values])

    def put(self, dt: str, rows: DataFrame) -> None:
        """``rows`` (keys and values) as the whole of day ``dt``, new or in place of what it was."""
        self._change(dt, rows.select(*self.columns), replace=True)

    def add(self, dt: str, rows: DataFrame) -> None:
        """``rows`` on top of what day ``dt`` has: late ones, without reading that day's log again."""
        self._change(dt, rows.select(*self.columns), replace=False)

    def _change(self, dt: str, rows: DataFrame, replace: bool) -> None:
        scratch = Scratch(self.spark)
        store, behind = self.day(dt), self._behind()
        old = self._day_rows(dt).select(*self.columns) if store.versions() else None
        if old is not None and not replace:
            rows = rows.unionByName(old)
        new, new_path = scratch.write(self._sum(rows), "store-day")
        change = new if old is None else self._sum(new.unionByName(self._minus(old)))
        change, change_path = scratch.write(change.withColumn("bucket", self.total.bucket(self.bucket_key)), "store-change")
        version = max([0, *store.versions(), *self.total.versions()]) + 1
        store.write(new, version)
        touched = {r[0] for r in change.select("bucket").distinct().collect()}
        self.merged_buckets = touched | behind
        parts = []
        if touched - behind:
            parts += [self.total.read_newest(touched - behind).select(*self.columns),
                      change.filter(~F.col("bucket").isin(list(behind))).select(*self.columns)]
        if behind:
            parts += [self._day_rows(d, behind).select(*self.columns) for d in self.days()]
        out = new.limit(0) if not parts else parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        self._write_total(self._sum(out), version)
        scratch.drop(new_path, change_path)
        for v in store.versions()[:-1]:
            store.drop(v)
        self.total.vacuum()

    def _write_total(self, rows: DataFrame, version: int) -> None:
        """Rows of the touched buckets, and in each of them a mark that is not alive, so that a bucket that
        lost all its rows is there, and empty. Readers leave marks out."""
        touched = self.spark.createDataFrame([(b,) for b in sorted(self.merged_buckets)], "bucket int")
        kinds = {f.name: f.dataType for f in self.total.schema.fields}
        marks = touched.select(*[(F.lit(0) if c == self.alive else F.lit(None)).cast(kinds[c]).alias(c)
                                 for c in self.columns], "bucket")
        out = rows.withColumn("bucket", self.total.bucket(self.bucket_key)).unionByName(marks)
        out.repartition("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(4))).write.mode("overwrite") \
           .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/total/v={version}")

    def _behind(self) -> set[int]:
        """Buckets of days whose version the totals lack: a put that did not end."""
        done = set(self.total.versions())
        return {b for dt in self.days() for v in self.day(dt).versions() if v not in done and v > max(done, default=0)
                for b in range(self.buckets)}

    def sums(self, buckets=None) -> DataFrame:
        """Keys and values over all days."""
        if self._behind():
            raise RuntimeError("a put did not end; put that day again")
        return self.total.read_newest(buckets).filter(F.col(self.alive) != 0).select(*self.columns)

    def sums_of(self, days: list[str]) -> DataFrame:
        """Keys and values over some days: only their parts are read."""
        rows = self.total.read([]).select(*self.columns)
        for dt in days:
            rows = rows.unionByName(self._day_rows(dt).select(*self.columns))
        return self._sum(rows)

    def bucket_of(self, value: Column) -> int:
        return self.spark.range(1).select(self.total.bucket(value)).first()[0]
