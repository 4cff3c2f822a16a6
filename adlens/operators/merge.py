"""Tag merging and list building.

Weights are summed in long form ``(key, kind, tag)``: partial aggregation before the shuffle
keeps the state per key constant, even for a key that holds a third of the log (the shared
anonymous user). Lists per key (a rendered profile, the members of a component) are built in
bounded chunks: a key with ``n`` items is split into ``ceil(n / chunk_size)`` chunks by a
hash of the item, so no single row or task has to hold an unbounded group. Small keys (the
normal case) get exactly one chunk holding the whole sorted list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.functions.scalar import md5_bucket
from adlens.operators.dimensions import DEFAULT_MAX_BROADCAST_ROWS, is_broadcastable

DEFAULT_CHUNK_SIZE = 10_000


def merge_tags(long_df: DataFrame, key: str | list[str], weight_col: str | None = None) -> DataFrame:
    """``(key, kind, tag, weight BIGINT)`` summed over all occurrences.

    Tags merge by their text within a family. Families carry distinct prefixes, so a tag
    text belongs to one family; keeping ``kind`` in the key keeps every aggregation buffer
    fixed-width, so Spark plans a hash aggregate with a map-side partial step.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = F.lit(1).cast("bigint") if weight_col is None else F.col(weight_col).cast("bigint")
    return long_df.groupBy(*keys, "kind", "tag").agg(F.sum(w).alias("weight"))


def chunked_collect(df: DataFrame, keys: list[str], item: Column, sort_key: Column,
                    chunk_size: int = DEFAULT_CHUNK_SIZE, out_col: str = "items",
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``(keys..., chunk, n_items, items)`` with each key's items split into bounded chunks.

    ``chunk`` = md5 bucket of ``sort_key`` among ``ceil(n / chunk_size)`` buckets, where ``n``
    is the key's item count; items inside a chunk are sorted by ``sort_key``. Only keys of more than one
    chunk need their count: these are few (at most rows / ``chunk_size``), stored, and broadcast if their
    measured size allows, so rows are exchanged once, by (key, chunk). Null keys are a group of their own.
    """
    base = df.select(*keys, sort_key.alias("__sk"), item.alias("__item"))
    hot = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > chunk_size)
    hot = hot.select(*[F.col(k).alias(f"__{k}") for k in keys], "__n").checkpoint(eager=True)
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    side = F.broadcast(hot) if is_broadcastable(hot, max_broadcast_rows) else hot.hint("merge")
    n_chunks = F.ceil(F.coalesce("__n", F.lit(1)) / F.lit(float(chunk_size)))
    with_chunk = base.join(side, same, "left").withColumn(
        "chunk", F.when(F.col("__n").isNull(), 0).otherwise(md5_bucket(F.col("__sk"), n_chunks).cast("int")))
    grouped = with_chunk.repartition(*keys, "chunk").groupBy(*keys, "chunk").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_sort(F.collect_list(F.struct(F.col("__sk").alias("k"), F.col("__item").alias("v"))))
         .alias("__sorted"))
    return grouped.select(*keys, "chunk", "n_items",
                          F.transform("__sorted", lambda x: x["v"]).alias(out_col))


def by_text(weights: DataFrame, key: str) -> DataFrame:
    """``(key, tag, weight)``: a tag text counts once per key, whichever families gave it."""
    return weights.groupBy(key, "tag").agg(F.sum("weight").alias("weight"))


def render_pairs(items: Column) -> Column:
    """C14: ``(tag,weight),(tag,weight)`` from an array of (tag, weight) structs."""
    return F.array_join(F.transform(items, lambda x: F.concat(
        F.lit("("), x["tag"], F.lit(","), x["weight"].cast("string"), F.lit(")"))), ",")


def profile_chunks(weights: DataFrame, key: str, chunk_size: int = DEFAULT_CHUNK_SIZE,
                   materialize: bool = True) -> DataFrame:
    """Rendered profile per key: ``(key, chunk, n_tags, tags)``, tags sorted by tag text.

    Weights of one text under several kinds are summed first. The sums are read twice (item
    lists and per-key counts), so by default they are checkpointed to the reliable checkpoint
    folder: the upstream log scan and tag aggregation then run once.
    """
    weights = by_text(weights, key)
    if materialize:
        weights = weights.checkpoint(eager=True)
    item = F.struct(F.col("tag").alias("tag"), F.col("weight").alias("weight"))
    chunks = chunked_collect(weights, [key], item, F.col("tag"), chunk_size, "__items")
    return chunks.select(key, "chunk", F.col("n_items").alias("n_tags"),
                         render_pairs(F.col("__items")).alias("tags"))


def profile_map(weights: DataFrame, key: str, chunk_size: int = DEFAULT_CHUNK_SIZE) -> DataFrame:
    """``(key, chunk, profile MAP<tag, weight>)``; each tag text is one map key."""
    weights = by_text(weights, key).checkpoint(eager=True)
    item = F.struct(F.col("tag").alias("tag"), F.col("weight").alias("weight"))
    chunks = chunked_collect(weights, [key], item, F.col("tag"), chunk_size, "__items")
    return chunks.select(key, "chunk", F.map_from_entries("__items").alias("profile"))


def top_tags(weights: DataFrame, key: str, n: int, kind: bool = False) -> DataFrame:
    """The ``n`` heaviest tags of each ``key`` with their ``rank`` (from 1): exact, ties by kind and tag.

    With ``kind`` the ranking is within (key, kind). The weights must be summed up. Each task passes on
    its own ``n`` best rows of a key only (a rank bound below the exchange), so of the shared anonymous user,
    however many tags it has, at most ``n`` rows per task meet in one place. Spark keeps that bound for ``n`` up to 1000.
    """
    groups = [key, "kind"] if kind else [key]
    rank = F.row_number().over(W.partitionBy(*groups).orderBy(F.col("weight").desc(), "kind", "tag"))
    return weights.select(key, "kind", "tag", "weight").withColumn("rank", rank).filter(F.col("rank") <= n)
