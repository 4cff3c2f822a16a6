"""Connected components of an undirected graph by contraction.

Label = smallest vertex id of the component (ids may be strings or numbers; the order is
the column type's order). Each round

1. hooks every vertex of the current graph to its smallest neighbour, if that is smaller
   (one partial + final ``min`` over both directions of the edge list);
2. shortcuts the resulting forest to its roots, four pointers at a step (``p(v) <- p(p(p(p(v))))``
   until the last of them changes nothing: as many steps as the log of its depth);
3. contracts: edges are renamed to their ends' roots, loops and repeats dropped.

Two rounds at least halve the vertices: a root that has more roots than hooked vertices around it
lends its label to the hooked ones, next to which the other roots are no longer smallest. So
rounds and doubling steps are logarithmic, on chains of any numbering too, and uncapped. Roots are the smallest
ids of their trees, so the last root is the smallest id of the component. Afterwards the rounds'
root tables are composed from the smallest (last) to the largest, which costs as much as the
first round alone. Every size of graph and type of id takes this one path.

Every table of a round is written under the reliable checkpoint folder: it cuts the lineage,
survives lost executors, and a join of two stored tables shuffles both sides, so AQE may split
a hub id or the label of a giant component. Tables no longer needed are deleted. The driver
sees one number per table, counted while it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.session import Scratch

# Pointers followed in one stored step of shortcutting.
JUMPS = 4


def symmetric_edges(edges: DataFrame, vertices: DataFrame | None = None,
                    src: str = "src", dst: str = "dst", id_col: str = "id") -> DataFrame:
    """Distinct directed pairs (a, b) of the undirected graph, with a self-loop per vertex."""
    a, b = F.col(src), F.col(dst)

    def pair(x, y):
        return F.struct(x.alias("a"), y.alias("b"))
    # One pass over the edge list emits both directions and both self-loops.
    e = (edges.filter(a.isNotNull() & b.isNotNull())
              .select(F.explode(F.array(pair(a, b), pair(b, a), pair(a, a), pair(b, b))).alias("p"))
              .select("p.a", "p.b"))
    if vertices is not None:
        v = vertices.select(F.col(id_col).alias("a")).filter(F.col("a").isNotNull())
        e = e.unionByName(v.select("a", F.col("a").alias("b")))
    return e.distinct()


def _ordered(pairs: DataFrame, a: Column, b: Column) -> DataFrame:
    """Distinct ``(a, b)`` with ``a <= b``."""
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _roots(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, str, int]:
    """``(v, p)``: the root of every vertex's tree of the hooking forest, and the steps taken."""
    def pair(x, y):
        return F.struct(F.col(x).alias("v"), F.col(y).alias("u"))
    hooks = (edges.select(F.explode(F.array(pair("a", "b"), pair("b", "a"))).alias("e")).select("e.v", "e.u")
                  .groupBy("v").agg(F.min("u").alias("u")).select("v", F.least("v", "u").alias("p")))
    p, path = scratch.write(hooks, "hooks")
    steps = 0
    while True:
        steps += 1
        # Four pointers at once: three joins with one stored table.
        up = p
        for k in range(1, JUMPS):
            on = p.select(F.col("v").alias("w"), F.col("p").alias(f"p{k}"))
            up = up.join(on, F.col(f"p{k - 1}" if k > 1 else "p") == F.col("w")).drop("w")
        last, before = F.col(f"p{JUMPS - 1}"), F.col(f"p{JUMPS - 2}")
        # If the last pointer moved nobody, all stand at their roots.
        nxt, nxt_path, moved = scratch.write_observed(
            up.select("v", last.alias("p"), (last < before).alias("moved")), "roots", F.count_if("moved"))
        scratch.drop(path)
        p, path = nxt.select("v", "p"), nxt_path
        if not moved:
            return p, path, steps


def _renamed(edges: DataFrame, p: DataFrame) -> DataFrame:
    a = p.select(F.col("v").alias("a"), F.col("p").alias("pa"))
    b = p.select(F.col("v").alias("b"), F.col("p").alias("pb"))
    return _ordered(edges.join(a, "a").join(b, "b").filter("pa <> pb"), F.col("pa"), F.col("pb"))


def connected_components(edges: DataFrame, vertices: DataFrame | None = None,
                         src: str = "src", dst: str = "dst", id_col: str = "id",
                         stats: dict | None = None) -> DataFrame:
    """``(id, component)`` for every vertex of ``edges`` (and of ``vertices`` if given), stored.

    Edges with a null end are ignored. ``stats`` receives ``rounds`` and ``steps`` (of
    shortcutting, over all rounds).
    """
    scratch = Scratch(edges.sparkSession)
    a, b = F.col(src), F.col(dst)
    pairs, pairs_path, left = scratch.write_observed(
        _ordered(edges.select(a.alias("a"), b.alias("b")).dropna(), F.col("a"), F.col("b")), "pairs", F.count_if(F.col("a") < F.col("b")))
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    if vertices is not None:
        ids = ids.unionByName(vertices.select(F.col(id_col).alias("id")).dropna())
    count = F.count(F.lit(1))
    cur, cur_path = pairs.filter("a < b"), None
    levels: list[tuple[DataFrame, str]] = []
    steps = 0
    while left:
        p, p_path, n = _roots(cur, scratch)
        steps += n
        levels.append((p, p_path))
        nxt, nxt_path, left = scratch.write_observed(_renamed(cur, p), "edges", count)
        if cur_path:
            scratch.drop(cur_path)
        cur, cur_path = nxt, nxt_path
    if stats is not None:
        stats.update(rounds=len(levels), steps=steps)
    ids = ids.distinct()
    done = [pairs_path] + [cur_path] * bool(cur_path)
    if not levels:
        labels, _ = scratch.write(ids.select("id", F.col("id").alias("component")), "components")
        scratch.drop(*done)
        return labels
    # The levels are composed from the last, smallest one; the first one together with the ids.
    top, top_path = levels.pop()
    while len(levels) > 1:
        lower, lower_path = levels.pop()
        up = top.select(F.col("v").alias("w"), F.col("p").alias("q"))
        composed, path = scratch.write(
            lower.join(up, lower["p"] == up["w"], "left").select("v", F.coalesce("q", "p").alias("p")), "labels")
        scratch.drop(top_path, lower_path)
        top, top_path = composed, path
    found = top.select(F.col("v").alias("w"), F.col("p").alias("q"))
    done.append(top_path)
    if levels:
        first, first_path = levels.pop()
        done.append(first_path)
        ids = ids.join(first.withColumnRenamed("v", "id"), "id", "left")
        out = ids.join(found, ids["p"] == found["w"], "left").select("id", F.coalesce("q", "p", "id").alias("component"))
    else:
        out = ids.join(found, ids["id"] == found["w"], "left").select("id", F.coalesce("q", "id").alias("component"))
    labels, _ = scratch.write(out, "components")
    scratch.drop(*done)
    return labels
