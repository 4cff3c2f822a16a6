"""S3 / P1 with K11 / J5: the log clustered by user, so that sums per user and the label join need no exchange.

The log is written as a bucketed table: a row lies in the bucket of its user key, which is a stored
column. Tag sums by user and the join of head ids with labels (bucketed alike) then run inside
the buckets. One exchange is paid when the log is written, instead of one in every job that reads it.

A bucket is one task, so a key that alone would fill one - the shared anonymous user holds a third of a
log - must not lie there. Keys with more rows than an average bucket are *loose*: there are fewer of them
than buckets, whatever the log, and their rows go to a plain table beside, where partial sums bring a hot
key down to a few rows per task. No key is in both tables, so their results are simply put together.

The tables belong to the session's catalog, their files to the folder the caller names: ``open`` declares
a folder that another session wrote.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators import identity as I
from adlens.operators.merge import merge_tags
from adlens.operators.tags import FAMILIES_V1, TagContext, row_tags

KEY = "user_key"
DEFAULT_BUCKETS = 256


def _check(name: str) -> str:
    if not re.fullmatch(r"[A-Za-z_]\w*", name):
        raise ValueError(f"a table name is letters, digits and _, not {name!r}")
    return name


def _write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """One file per bucket: rows are dealt by the hash that the buckets use."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("compression", "snappy")
       .option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table))


class ClusteredLog:
    """``<name>`` (settled keys, bucketed) and ``<name>_loose`` (hot keys) under ``path``."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = DEFAULT_BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, _check(name), path.rstrip("/"), buckets

    @property
    def settled(self) -> DataFrame:
        return self.spark.table(self.name)

    @property
    def loose(self) -> DataFrame:
        return self.spark.read.schema(self.settled.schema).parquet(f"{self.path}/loose")

    def write(self, log: DataFrame) -> "ClusteredLog":
        """The log's rows, clustered; what lay under ``path`` before is replaced."""
        keyed = log.withColumn(KEY, I.user_key())
        counts = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"))
        rows = log.count()
        # Each has more than rows / buckets rows, so there are fewer of them than buckets.
        hot = [r[0] for r in counts.filter(F.col("n") * self.buckets > rows).select(KEY).collect()]
        _write_bucketed(keyed.filter(~F.col(KEY).isin(hot)), self.name, f"{self.path}/settled", KEY, self.buckets)
        keyed.filter(F.col(KEY).isin(hot)).write.mode("overwrite").parquet(f"{self.path}/loose")
        return self

    def open(self) -> "ClusteredLog":
        """Declare the tables of a folder that is there already (same number of buckets)."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*S.LOG_SCHEMA.fields])
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}, {KEY} string) USING parquet CLUSTERED BY ({KEY}) "
                       f"SORTED BY ({KEY}) INTO {int(self.buckets)} BUCKETS LOCATION '{self.path}/settled'")
        return self

    # --- K11: tag sums per user ----------------------------------------------------------------------------
    def settled_weights(self, ctx: TagContext, families: list[str] = FAMILIES_V1) -> DataFrame:
        """``(user_key, kind, tag, weight)`` of the bucketed keys: one stage, scan to sums."""
        return merge_tags(row_tags(self.settled, families, ctx, [KEY]), KEY)

    def weights(self, ctx: TagContext, families: list[str] = FAMILIES_V1) -> DataFrame:
        """``(user_key, kind, tag, weight)`` of all rows, as ``user_profiles`` gives it."""
        loose = merge_tags(row_tags(self.loose, families, ctx, [KEY]), KEY)
        return self.settled_weights(ctx, families).unionByName(loose)

    # --- J5: labels ------------------------------------------------------------------------------------------
    def write_labels(self, labels: DataFrame) -> None:
        """``(id, component)`` bucketed like the log."""
        _write_bucketed(labels.select("id", "component"), f"{self.name}_labels", f"{self.path}/labels", "id", self.buckets)

    def settled_components(self, keep: list[str]) -> DataFrame:
        """Bucketed rows with their component: a merge join inside the buckets."""
        labels = self.spark.table(f"{self.name}_labels").withColumnRenamed("id", KEY)
        return self.settled.select(KEY, *keep).hint("merge").join(labels, KEY).select(*keep, "component")

    def components(self, keep: list[str]) -> DataFrame:
        """``keep`` and ``component`` of every row that has an id, as ``attach_component`` gives it.

        A user key is the row's head id, or the anonymous key, which is nobody's id. Loose keys are fewer than
        buckets, so their labels are a proven few rows and are sent out.
        """
        loose = self.loose.select(KEY, *keep)
        few = self.spark.table(f"{self.name}_labels").withColumnRenamed("id", KEY).join(
            loose.select(KEY).distinct(), KEY, "left_semi")
        return self.settled_components(keep).unionByName(
            loose.join(F.broadcast(few), KEY).select(*keep, "component"))
