"""I5 kept up to date: a day's edges merge into stored component labels.

The store is a forest of parent pointers ``(id, parent)`` in hash buckets, one version per
increment; the last version of an id counts. An id points to the smallest id of its component as
it was when the pointer was written; where components have merged since, the former smallest id
points on to the new one. So an increment

1. looks up the ends of its edges, reading only the buckets that they and the smallest ids on
   their way lie in;
2. renames the edges to these smallest ids and finds the components of that small graph by the
   same contraction as a full run;
3. writes one version: new ids, ids on the way that were behind, and the components that got
   another name. Components that no edge touches are neither read as rows nor written.

Labels are the smallest ids, as in a full run, whatever the order of the increments. Pointer
chains are at most as long as there are versions; ``compact`` shortens them to one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators.components import connected_components
from adlens.operators.dimensions import is_broadcastable
from adlens.session import Scratch
from adlens.sources.bucket_store import DEFAULT_BUCKETS, BucketStore


class ComponentStore:
    def __init__(self, spark: SparkSession, path: str, id_type: str = "string", buckets: int = DEFAULT_BUCKETS):
        self.spark = spark
        self.store = BucketStore(spark, path, f"id {id_type}, parent {id_type}, component boolean", "id", buckets)
        self.read_buckets: set[int] = set()

    def _pointers(self, keys: DataFrame, versions: list[int]) -> DataFrame:
        """``at, parent`` of the distinct stored ids among ``keys`` (``at``)."""
        buckets = [r[0] for r in keys.select(self.store.bucket("at")).distinct().collect()]
        self.read_buckets.update(buckets)
        rows = self.store.read(versions, buckets).withColumnRenamed("id", "at")
        keys = F.broadcast(keys) if is_broadcastable(keys) else keys.hint("merge")
        return rows.join(keys, "at", "left_semi").groupBy("at").agg(F.max_by("parent", "v").alias("parent"))

    def _resolve(self, ids: DataFrame, versions: list[int], scratch: Scratch) -> tuple[DataFrame, str]:
        """``id, first, root``: the stored pointer of each id (null: none) and its component's smallest id."""
        cur, path = scratch.write(ids.select("id", F.lit(None).cast(ids.schema["id"].dataType).alias("first"),
                                             F.col("id").alias("root"), F.lit(True).alias("moved")), "store-paths")
        first = True
        while versions:
            keys, keys_path = scratch.write(cur.filter("moved").select(F.col("root").alias("at")).distinct(), "store-keys")
            known = self._pointers(keys, versions)
            on = cur.join(known, cur["root"] == known["at"], "left")
            parent = F.when(F.col("moved"), F.col("parent"))
            nxt, nxt_path = scratch.write(on.select(
                "id", (parent if first else F.col("first")).alias("first"), F.coalesce(parent, "root").alias("root"),
                F.coalesce(parent != F.col("root"), F.lit(False)).alias("moved")), "store-paths")
            scratch.drop(path, keys_path)
            cur, path, first = nxt, nxt_path, False
            if cur.filter("moved").isEmpty():
                break
        return cur.select("id", "first", "root"), path

    def apply(self, edges: DataFrame, version: int, src: str = "src", dst: str = "dst") -> None:
        """Merge ``edges`` (self-loops name single ids; edges with a null end are ignored) as ``version``.

        Running a version again replaces it, as long as no later one is there.
        """
        versions = [v for v in self.store.versions() if v != version]
        if versions and versions[-1] > version:
            raise ValueError(f"version {versions[-1]} is already there, {version} comes too late")
        scratch = Scratch(self.spark)
        pairs, pairs_path = scratch.write(
            edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna()
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "store-pairs")
        ids, ids_path = scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "store-ids")
        found, found_path = self._resolve(ids, versions, scratch)
        a = found.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        b = found.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        renamed, renamed_path = scratch.write(
            pairs.filter("a < b").join(a, "a").join(b, "b").filter("ra <> rb")
                 .select(F.least("ra", "rb").alias("src"), F.greatest("ra", "rb").alias("dst")).distinct(), "store-edges")
        names, names_path = scratch.write(connected_components(renamed), "store-names")
        # Former smallest ids that were stored as such, and now have another above them.
        known, known_path = scratch.write(found.filter("first IS NOT NULL").select(F.col("root").alias("id")).distinct(), "store-known")
        merged = names.filter("id <> component").join(known, "id", "left_semi").select(
            "id", F.col("component").alias("parent"), F.lit(True).alias("component"))
        label = F.coalesce(F.col("component"), F.col("root"))
        moved = found.join(names.withColumnRenamed("id", "root"), "root", "left").select(
            "id", "first", label.alias("parent")).filter(F.col("first").isNull() | (F.col("first") != F.col("parent"))).select(
            "id", "parent", F.lit(False).alias("component")).join(merged.select("id"), "id", "left_anti")
        self.store.write(moved.unionByName(merged), version)
        scratch.drop(pairs_path, ids_path, found_path, renamed_path, names_path, known_path)

    def renames(self, version: int) -> DataFrame:
        """``former, component``: the components that ``version`` gave another name. What is keyed by
        component, such as a person's profile, changes its key by this table alone."""
        return self.store.read([version]).filter("component").select(F.col("id").alias("former"), F.col("parent").alias("component"))

    def labels(self, up_to: int | None = None) -> DataFrame:
        """``id, component`` of all ids, as of a version."""
        versions = [v for v in self.store.versions() if up_to is None or v <= up_to]
        scratch = Scratch(self.spark)
        cur, path = scratch.write(self.store.read(versions).groupBy("id").agg(F.max_by("parent", "v").alias("p")), "store-labels")
        while True:
            # Only an id that others point to can be between them and their component.
            inner = cur.filter("p <> id").select(F.col("id").alias("w"), F.col("p").alias("q"))
            tops = cur.select(F.col("p").alias("w")).distinct()
            inner, inner_path = scratch.write(inner.join(tops, "w", "left_semi"), "store-inner")
            if inner.isEmpty():
                scratch.drop(inner_path)
                return cur.select("id", F.col("p").alias("component"))
            inner_side = F.broadcast(inner) if is_broadcastable(inner) else inner.hint("merge")
            nxt, nxt_path = scratch.write(cur.join(inner_side, cur["p"] == inner_side["w"], "left").select(
                "id", F.coalesce("q", "p").alias("p")), "store-labels")
            scratch.drop(path, inner_path)
            cur, path = nxt, nxt_path

    def compact(self, version: int) -> None:
        """All labels as one version, in place of those before it."""
        old = self.store.versions()
        self.store.write(self.labels().select("id", F.col("component").alias("parent"), F.lit(False).alias("component")), version)
        self.store.drop(*[v for v in old if v < version])
