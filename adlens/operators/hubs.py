"""Placeholder ids found by their degree instead of listed by hand.

An all-zero device id stands on the rows of many people and would fuse them into one. Such an id
shows by its degree: the number of distinct other ids that it shares a row with. Degrees are
kept as HyperLogLog sketches per id, which are small, merge over days and need no distinct shuffle; ids
whose estimate comes near the threshold of their kind are candidates, and only for these the exact degree is
counted. So every reported degree is exact, and a hub would be missed only if a sketch was wrong by
more than ``MARGIN`` (over six standard errors).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.operators.dimensions import is_broadcastable

DEFAULT_THRESHOLD = 1000
# 2 ** 12 registers: a standard error of 1.6 %.
SKETCH_BITS = 12
MARGIN = 0.1


def kind_of(id_col: str | Column) -> Column:
    """The two-letter kind that each id begins with."""
    return F.substring(id_col, 1, 2)


def threshold_of(kind: Column, thresholds: dict[str, int] | None, default: int) -> Column:
    out = F.lit(default)
    for k, n in (thresholds or {}).items():
        out = F.when(kind == k, n).otherwise(out)
    return out


def co_occurrences(df_ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``id, other``: the ids of each row, each with each other one (a row has at most fifteen)."""
    ids = F.col(ids_col)
    pairs = F.flatten(F.transform(ids, lambda a: F.transform(
        F.filter(ids, lambda b: b != a), lambda b: F.struct(a.alias("id"), b.alias("other")))))
    return df_ids.select(F.explode(pairs).alias("p")).select("p.*")


def degree_sketches(df_ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``id, sketch`` of one log; sketches of several logs merge by :func:`merge_sketches`."""
    return co_occurrences(df_ids, ids_col).groupBy("id").agg(F.hll_sketch_agg("other", SKETCH_BITS).alias("sketch"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("id").agg(F.hll_union_agg("sketch").alias("sketch"))


def hub_candidates(sketches: DataFrame, thresholds: dict[str, int] | None = None,
                   default: int = DEFAULT_THRESHOLD) -> DataFrame:
    """``id``: those whose estimated degree is not clearly below the threshold of their kind."""
    least = threshold_of(kind_of("id"), thresholds, default) * (1 - MARGIN)
    return sketches.filter(F.hll_sketch_estimate("sketch") >= least).select("id")


def side(ids: DataFrame) -> DataFrame:
    """``ids`` for a join: broadcast if its measured size allows."""
    return F.broadcast(ids) if is_broadcastable(ids) else ids.hint("merge")


def hub_ids(df_ids: DataFrame, thresholds: dict[str, int] | None = None, default: int = DEFAULT_THRESHOLD,
            sketches: DataFrame | None = None, ids_col: str = "ids") -> DataFrame:
    """``id, kind, degree``: ids that share rows with at least so many distinct others, stored.

    ``thresholds`` by kind, ``default`` for the others. ``sketches`` (merged over days) spares the
    log's own; the log must then hold the rows of all these days.
    """
    found = hub_candidates(degree_sketches(df_ids, ids_col) if sketches is None else sketches, thresholds, default)
    found = found.checkpoint(eager=True)
    pairs = co_occurrences(df_ids, ids_col).join(side(found), "id", "left_semi").distinct()
    degrees = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("degree")).withColumn("kind", kind_of("id"))
    return degrees.filter(F.col("degree") >= threshold_of(F.col("kind"), thresholds, default)) \
        .select("id", "kind", "degree").checkpoint(eager=True)


def edges_without(df_ids: DataFrame, hubs: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Distinct edges between the ids of a row that are no hubs, a self-loop for each of them.

    All pairs of a row, not a star from its first id: the first may be a hub, and what the
    others share must hold without it.
    """
    ids = F.col(ids_col)
    pairs = F.flatten(F.transform(ids, lambda a: F.transform(
        F.filter(ids, lambda b: b >= a), lambda b: F.struct(a.alias("src"), b.alias("dst")))))
    edges = df_ids.select(F.explode(pairs).alias("e")).select("e.*").distinct()
    out = hubs.select("id")
    for end in ("src", "dst"):
        edges = edges.join(side(out.withColumnRenamed("id", end)), end, "left_anti")
    return edges.select("src", "dst")


def kept_heads(df_ids: DataFrame, hubs: DataFrame, ids_col: str = "ids") -> DataFrame:
    """``ids, head``: the first id of each distinct list that is no hub; lists of hubs only are left out."""
    lists = df_ids.select(ids_col).distinct()
    each = lists.select(ids_col, F.posexplode(ids_col).alias("pos", "id"))
    return each.join(side(hubs.select("id")), "id", "left_anti").groupBy(ids_col).agg(F.min_by("id", "pos").alias("head"))
