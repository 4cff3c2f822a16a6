"""Approximate nearest neighbours by adaptive dimension scan inside probed lists.

Index: centroids are fitted on a bounded sample (``SAMPLE`` rows by hash order), every vector
is assigned to its nearest one. Search: a query probes the lists nearest to it. Vectors and
queries are turned by one random rotation, after which any few columns are a fair sample of a
distance. Inside a list the columns are read in blocks; after each block a candidate whose partial
distance is too large for the distance of the k-th best found so far - by a hypothesis test with ``EPSILON``
deviations - is abandoned. Those that survive all blocks get their exact distance from the
original vectors.

A list's vectors are cut into groups of ``GROUP`` rows and its queries into groups of
``QUERY_GROUP``, so a list with a third of all rows, or of all queries, is many tasks. A
query's k best of every group meet in one bounded window.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored

SAMPLE = 20_000
MAX_LISTS = 4096
PROBED = 0.6
EPSILON = 2.1
COLUMNS = 16
GROUP = 8192
QUERY_GROUP = 8192
_PAIRS = 1 << 20
_SCAN = 1024
SEED = 11


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def centroids_of(sample: np.ndarray, lists: int, turns: int = 8) -> np.ndarray:
    """k-means centres; a centre that loses all rows stays where it is."""
    rng = np.random.default_rng(SEED)
    centres = sample[np.sort(rng.choice(len(sample), lists, replace=False))]
    for _ in range(turns):
        own = nearest(sample, centres)
        order = np.argsort(own, kind="stable")
        used, first = np.unique(own[order], return_index=True)
        sums = np.add.reduceat(sample[order], first, axis=0)
        centres[used] = sums / np.diff([*first, len(own)])[:, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), np.int64)
    for at in range(0, len(rows), 4096):
        out[at:at + 4096] = ((centres ** 2).sum(1) - 2 * rows[at:at + 4096] @ centres.T).argmin(1)
    return out


def adaptive_scan(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int,
                  turned: np.ndarray, columns: int = COLUMNS, epsilon: float = EPSILON):
    """(query number, vector number, distance) of each query's ``k`` best; its own id is no candidate."""
    dim = vectors.shape[1]
    rows, asked = vectors @ turned, queries @ turned
    nq = len(queries)
    best_d, best_v = np.full((nq, k), np.inf), np.full((nq, k), -1)
    edges = [*range(columns, dim, columns), dim]
    # Part of the squared distance that `d` of `dim` columns may hold of a candidate within radius 1.
    room = [(d / dim) * (1 + epsilon / np.sqrt(d)) ** 2 if d < dim else 1 + 1e-9 for d in edges]
    order = np.argsort(ids, kind="stable")  # so that ties are met from the smallest id on
    for at in range(0, len(order), _SCAN):
        part = order[at:at + _SCAN]
        for first in range(0, nq, max(1, _PAIRS // len(part))):
            own = np.arange(first, min(nq, first + max(1, _PAIRS // len(part))))
            radius = best_d[own, -1] ** 2
            a, b = asked[own, :edges[0]], rows[part, :edges[0]]
            near = (a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * a @ b.T
            qi, vi = np.nonzero((near <= radius[:, None] * room[0] + 1e-12) & (ids[part] != query_ids[own][:, None]))
            near, qn, vn = near[qi, vi], own[qi], part[vi]
            for lo, hi, share in zip(edges, edges[1:], room[1:]):
                near = near + ((asked[qn, lo:hi] - rows[vn, lo:hi]) ** 2).sum(1)
                live = near <= best_d[qn, -1] ** 2 * share + 1e-12
                near, qn, vn = near[live], qn[live], vn[live]
            exact = np.sqrt(((queries[qn] - vectors[vn]) ** 2).sum(1))
            qn, vn, exact = np.r_[qn, np.repeat(own, k)], np.r_[vn, best_v[own].ravel()], np.r_[exact, best_d[own].ravel()]
            full = vn >= 0
            qn, vn, exact = qn[full], vn[full], exact[full]
            rank = np.lexsort((ids[vn], exact, qn))
            qn, vn, exact = qn[rank], vn[rank], exact[rank]
            place = np.arange(len(qn)) - np.searchsorted(qn, qn)
            top = place < k
            best_d[qn[top], place[top]], best_v[qn[top], place[top]] = exact[top], vn[top]
    qn, place = np.nonzero(best_v >= 0)
    return qn, best_v[qn, place], best_d[qn, place]


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v, row``, stored: the rows with an id whose vector is not null or zero and has only finite
    components, of any length. Rows alike in id and vector count once; different vectors of one id are
    rows of their own. ``row`` numbers them."""
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    clean = (pick(rows, vec_id=id_col, v=vector_col).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
             .filter(ok).distinct())
    return stored(clean.withColumn("row", F.monotonically_increasing_id()), "ann-vectors")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, probed: float = PROBED) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``vectors`` and ``queries`` (``vec_id, v, row``, as ``usable`` gives).

    Lists are probed from the nearest on: the share ``probed`` of all lists, and further ones
    until ``k`` other vectors are in reach, so small tables return all there is. Ties go to
    the smaller id. Without vectors or queries there are no rows.

    Candidates of a query are the rows of other ids whose vectors are as long as its own; each length that queries
    have is searched by itself. An id with several vectors may come up once for each. A query id with several
    vectors is one query: a candidate's score is the one to the nearest of them.
    """
    spark = vectors.sparkSession
    found = spark.createDataFrame([], FOUND)
    # Lengths of vectors, not rows, reach the driver.
    for length in sorted(r[0] for r in queries.select(F.size("v")).distinct().collect()):
        same = F.size("v") == length
        found = found.unionByName(_of_length(vectors.filter(same), queries.filter(same), k, probed))
    nearest_of = found.groupBy("query_id", "row", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return nearest_of.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


FOUND = "query_id long, row long, vec_id long, score double"


def _of_length(vectors: DataFrame, queries: DataFrame, k: int, probed: float) -> DataFrame:
    """``FOUND`` rows among vectors of one length: each query vector's best of every group of a probed list."""
    n = vectors.count()
    lists = min(MAX_LISTS, n, 1 << round(np.log2(n) / 2))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).select("v").toPandas()
    centres = centroids_of(_matrix(sample["v"]), lists)
    turned = rotation(centres.shape[1])
    kind = vectors.schema["v"].dataType.simpleString()

    def assign(parts):
        for rows in parts:
            if len(rows):
                yield rows.assign(list=nearest(_matrix(rows["v"]), centres).astype(np.int32))

    assigned = stored(vectors.mapInPandas(assign, f"vec_id long, v {kind}, row long, list int"), "ann-lists")
    # One number per list, so at most MAX_LISTS rows.
    sizes = np.zeros(lists, np.int64)
    for r in assigned.groupBy("list").count().collect():
        sizes[r["list"]] = r["count"]
    wanted = max(1, int(np.ceil(probed * lists)))

    def probe(parts):
        for rows in parts:
            for at in range(0, len(rows), 1024):
                part = rows.iloc[at:at + 1024]
                x = _matrix(part["v"])
                order = np.argsort((centres ** 2).sum(1) - 2 * x @ centres.T, axis=1, kind="stable")
                reach = np.cumsum(sizes[order], axis=1)
                last = np.maximum(wanted, (reach < k + 1).sum(axis=1) + 1)
                which, place = np.nonzero((np.arange(lists) < last[:, None]) & (sizes[order] > 0))
                yield pd.DataFrame({"query_id": part["vec_id"].to_numpy()[which], "v": part["v"].to_numpy()[which],
                                    "query_row": part["row"].to_numpy()[which], "list": order[which, place].astype(np.int32)})

    asked = stored(queries.mapInPandas(probe, f"query_id long, v {kind}, query_row long, list int"), "ann-probes")
    askers = np.zeros(lists, np.int64)
    for r in asked.groupBy("list").count().collect():
        askers[r["list"]] = r["count"]

    def cut(id_col: str, mine: np.ndarray, my_size: int, other: np.ndarray, other_size: int, a: str, b: str):
        """Each row's own group of its list, times all groups of the other side."""
        own = F.array(*[F.lit(int(x)) for x in np.maximum(1, -(-mine // my_size))])
        rest = F.array(*[F.lit(int(x)) for x in np.maximum(1, -(-other // other_size))])
        at = F.col("list") + 1
        return [F.pmod(F.xxhash64(id_col), F.element_at(own, at)).cast("int").alias(a),
                F.explode(F.sequence(F.lit(0), F.element_at(rest, at) - 1)).alias(b)]

    left = assigned.select("vec_id", "v", "row", "list", *cut("row", sizes, GROUP, askers, QUERY_GROUP, "vg", "qg"))
    right = asked.select("query_id", "v", "list", *cut("query_row", askers, QUERY_GROUP, sizes, GROUP, "qg", "vg"))

    def scan(rows: pd.DataFrame, wants: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(wants):
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []}).astype(
                {"query_id": int, "row": int, "vec_id": int})
        ids, query_ids = rows["vec_id"].to_numpy(), wants["query_id"].to_numpy()
        q, v, d = adaptive_scan(_matrix(rows["v"]), ids, _matrix(wants["v"]), query_ids, k, turned)
        return pd.DataFrame({"query_id": query_ids[q], "row": rows["row"].to_numpy()[v], "vec_id": ids[v], "score": d})

    keys = ["list", "vg", "qg"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(scan, FOUND)


def op2(embeddings: DataFrame) -> DataFrame:
    vectors = usable(embeddings, "vec_id", "embedding")
    return search(vectors, vectors.filter("vec_id % 100 = 0"))
