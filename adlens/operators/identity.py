"""Identity: user keys, id lists, vertices and edges (I1-I4), component attachment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import not_blank
from adlens.operators.dimensions import DEFAULT_MAX_BROADCAST_ROWS, is_broadcastable


def _prefixed_ids(deny_ids: list[str] | None = None) -> list[Column]:
    """Prefixed id per column, null when blank. Ids in ``deny_ids`` (prefixed placeholder
    values such as an all-zero IMEI, which would fuse everybody into one person) are
    treated like blank columns; the guard is off unless a deny-list is given."""
    out = []
    for c, p in S.ID_COLUMNS:
        pid = F.concat(F.lit(p), F.col(c))
        cond = not_blank(c) if not deny_ids else not_blank(c) & ~pid.isin(list(deny_ids))
        out.append(F.when(cond, pid))
    return out


def user_key(deny_ids: list[str] | None = None) -> Column:
    """First non-blank id in priority order with its kind prefix, else the anonymous key."""
    return F.coalesce(head_id(deny_ids), F.lit(S.OTHER))


def all_ids(deny_ids: list[str] | None = None) -> Column:
    """Every non-blank id of the row in priority order, duplicates removed."""
    return F.array_distinct(F.array_compact(F.array(*_prefixed_ids(deny_ids))))


def with_ids(df: DataFrame, out_col: str = "ids", deny_ids: list[str] | None = None) -> DataFrame:
    return df.withColumn(out_col, all_ids(deny_ids))


def vertices(df_ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Distinct ids over all rows (rows without any id contribute nothing)."""
    return df_ids.select(F.explode(ids_col).alias("id")).distinct()


def head_id(deny_ids: list[str] | None = None) -> Column:
    """The row's first id, null without any: the head of ``all_ids`` without building the array."""
    return F.coalesce(*_prefixed_ids(deny_ids))


def edges(df_ids: DataFrame, ids_col: str = "ids") -> DataFrame:
    """I4: star edges from each row's first id to each of its ids (self-loop included)."""
    return df_ids.select(F.get(ids_col, F.lit(0)).alias("src"), F.explode(ids_col).alias("dst")).distinct()


def attach_component(df: DataFrame, labels: DataFrame, head: Column | None = None,
                     keep: list[str] | None = None,
                     max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Each row with ids gets the component of its first id (inner join on that id).

    The labels table has one row per id. It is broadcast when its counted size is within
    the bound; otherwise the join is a sort-merge join on the head id (never a broadcast of
    the log side), where AQE splits a hot head id (a placeholder device id) across tasks.
    """
    rows = df.withColumn("__head", head_id() if head is None else head).filter(F.col("__head").isNotNull())
    lab = labels.select(F.col("id").alias("__head"), "component")
    lab = F.broadcast(lab) if is_broadcastable(lab, max_broadcast_rows) else lab.hint("merge")
    return rows.join(lab, "__head", "inner").select(*(df.columns if keep is None else keep), "component")
