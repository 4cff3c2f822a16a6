"""Profiles per primary id, per resolved person, and component listings.

P3 (v1): every log row -> user key (I1) + tags of six families -> weights per (user, tag).
P4 (v2): ids per row -> star edges -> connected components -> each row's tags go to the
component of its first id; every id of the component is listed with weight 0.
P5: members of each component, as bounded sorted lists.

Plan shape of P4: log scan -> ids (project) -> edges (distinct) -> component loop (stored) ->
``(id, component)``; log scan -> tags summed by (head id, kind, tag) -> join with the labels on the
head id -> summed again by component. Log rows are never shuffled for the join, a hot head id is a few
summed rows, and tags are never copied onto vertices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators import identity as I
from adlens.operators.components import connected_components
from adlens.operators.hubs import edges_without, kept_heads, side
from adlens.operators.merge import chunked_collect, merge_tags
from adlens.operators.tags import FAMILIES_V1, FAMILIES_V2, TagContext, row_tags


def user_tag_long(log: DataFrame, ctx: TagContext, families: list[str] = FAMILIES_V1,
                  deny_ids: list[str] | None = None) -> DataFrame:
    """``(user_key, kind, tag)`` one row per tag occurrence."""
    keyed = log.withColumn("user_key", I.user_key(deny_ids))
    return row_tags(keyed, families, ctx, ["user_key"])


def user_profiles(log: DataFrame, ctx: TagContext, families: list[str] = FAMILIES_V1,
                  deny_ids: list[str] | None = None) -> DataFrame:
    """``(user_key, kind, tag, weight)``."""
    return merge_tags(user_tag_long(log, ctx, families, deny_ids), "user_key")


def identity_graph(log: DataFrame, deny_ids: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with ``ids``, star edges)."""
    with_ids = I.with_ids(log, deny_ids=deny_ids)
    return with_ids, I.edges(with_ids)


def id_lists(log: DataFrame, deny_ids: list[str] | None = None) -> DataFrame:
    """``ids``: the distinct id lists of the log. Hubs, edges and heads depend on these only."""
    return I.with_ids(log.select(*[c for c, _ in S.ID_COLUMNS]), deny_ids=deny_ids).select("ids").distinct()


def resolve_identities(log: DataFrame, stats: dict | None = None,
                       deny_ids: list[str] | None = None, hubs: DataFrame | None = None,
                       lists: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` over the identity graph of the log, without ``hubs`` (``id``) if given.

    ``lists`` (:func:`id_lists` of the log, stored) spares another pass over the log for the graph without hubs.
    """
    with_ids, edges = identity_graph(log.select(*[c for c, _ in S.ID_COLUMNS]), deny_ids)
    if hubs is not None:
        edges = edges_without(with_ids if lists is None else lists, hubs)
    return connected_components(edges, stats=stats)


def person_profiles(log: DataFrame, ctx: TagContext, families: list[str] = FAMILIES_V2,
                    labels: DataFrame | None = None, deny_ids: list[str] | None = None,
                    hubs: DataFrame | None = None, lists: DataFrame | None = None) -> DataFrame:
    """``(component, kind, tag, weight)`` including each id with weight 0.

    With ``hubs`` (``id``, from :func:`adlens.operators.hubs.hub_ids`) a row belongs to the person of its
    first id that is no hub; rows of hubs only belong to nobody. ``lists`` are the log's stored :func:`id_lists`, if at hand.
    """
    if labels is None:
        labels = resolve_identities(log, deny_ids=deny_ids, hubs=hubs, lists=lists)
    if hubs is None:
        headed = log.withColumn("__id", I.head_id(deny_ids)).filter(F.col("__id").isNotNull())
        by_head = merge_tags(row_tags(headed, families, ctx, ["__id"]), "__id")
    else:
        by_head = _by_kept_head(log, ctx, families, deny_ids, hubs, lists)
    tag_long = I.attach_component(by_head, labels, F.col("__id"), ["kind", "tag", "weight"],
                                  **ctx.join_kw()).select("component", "kind", "tag", "weight")
    id_long = labels.select("component", F.lit("id").alias("kind"), F.col("id").alias("tag"),
                            F.lit(0).cast("bigint").alias("weight"))
    return merge_tags(tag_long.unionByName(id_long), "component", "weight")


def _by_kept_head(log: DataFrame, ctx: TagContext, families: list[str], deny_ids: list[str] | None,
                  hubs: DataFrame, lists: DataFrame | None) -> DataFrame:
    """``(__id, kind, tag, weight)`` by the first id of a row that is no hub.

    Mostly that is the row's first id: tags are summed by it. Only rows that begin with a hub are summed by their
    list of ids, and their distinct lists looked up.
    """
    first = log.withColumn("__id", I.head_id(deny_ids)).filter(F.col("__id").isNotNull())
    hub = side(hubs.select(F.col("id").alias("__hub")))
    lists = (id_lists(log, deny_ids) if lists is None else lists).withColumnRenamed("ids", "__list")
    begun = lists.join(hub, F.get("__list", F.lit(0)) == F.col("__hub"), "left_semi")
    heads = kept_heads(begun, hubs, "__list").checkpoint(eager=True)
    is_hub = F.col("__hub").isNotNull()
    keyed = first.join(hub, F.col("__id") == F.col("__hub"), "left").withColumns(
        {"__ids": F.when(is_hub, I.all_ids(deny_ids)), "__id": F.when(~is_hub, F.col("__id"))})
    summed = merge_tags(row_tags(keyed, families, ctx, ["__id", "__ids"]), ["__id", "__ids"])
    # A first id alone is no list of ``heads``, all of which begin with a hub; it keeps a shuffle even.
    on = F.coalesce("__ids", F.array("__id")) == F.col("__list")
    return summed.join(side(heads), on, "left").withColumn("__id", F.coalesce("__id", "head")) \
        .filter(F.col("__id").isNotNull()).select("__id", "kind", "tag", "weight")


def component_members(labels: DataFrame, payload: DataFrame | None = None, id_col: str = "id",
                      chunk_size: int | None = None) -> DataFrame:
    """``(component, chunk, n_items, members)``; members sorted by id within a chunk.

    With a ``payload`` DataFrame keyed by ``id_col`` each member is the payload struct.
    """
    kw = {} if chunk_size is None else {"chunk_size": chunk_size}
    if payload is None:
        return chunked_collect(labels, ["component"], F.col("id"), F.col("id"), out_col="members", **kw)
    joined = labels.join(payload.withColumnRenamed(id_col, "id"), "id")
    item = F.struct(*[F.col(c) for c in joined.columns if c != "component"])
    return chunked_collect(joined, ["component"], item, F.col("id"), out_col="members", **kw)
