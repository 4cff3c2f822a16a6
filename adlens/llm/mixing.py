"""Mixing sources to target weights by Pareto order sampling.

Targets: every source gets its weight's part of the mix, no more than ``limit`` times its own
size; what a full source cannot take is reshared by weight (water-filling over a table with
one row per source). Within a source a document is expected ``min(limit, c * g)`` times, where
``g`` grows with its size class (about the root of its size) and ``c`` makes the words meet the
target. The whole part of that number is taken for certain; the rest is an inclusion
probability ``p``, and the remaining words are drawn by ranking documents by the random odds
``u / (1 - u)`` over the inclusion odds ``p / (1 - p)``. The sample's size is fixed in words: the
ranking is cut where its running total is nearest to what the target still wants.

The ranking is never sorted as a whole. Ranks are mapped to (0, 1) and summed in 256 buckets
per source, the bucket that holds the cut is summed in 256 finer ones, and so once more; only
documents in the last bucket are ordered by a window, so a source with a third of all rows costs what the
others cost. Rows alike in id and text are one entry with a count. All steps are DataFrame
functions; documents are stored once and not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.llm.common import Positional, pick, stored, words_of
from adlens.operators.dimensions import is_broadcastable

CYCLE = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
SEED = "mix-1"
BUCKETS, LEVELS = 256, 3


def _drawn(frame: DataFrame, doc_id: str, text: str, source: str, seed: str) -> DataFrame:
    """``frame`` plus ``_source, _id, _size`` (words), ``_class`` (of size) and ``_u`` in (0, 1)."""
    t = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), t))
    number = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (frame.withColumns({"_source": F.col(source).cast("string"), "_id": F.col(doc_id),
                               "_size": F.size(words_of(t)).cast("long"),
                               "_u": (number + 0.5) / F.lit(float(1 << 52))})
                 .withColumn("_class", F.when(F.col("_size") > 0, F.floor(F.length(F.bin("_size")) / 2))
                             .otherwise(0).cast("int")))


def targets(sizes: DataFrame, cycle=CYCLE, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """``_source, source_size, target`` from ``_source, source_size``: one row per source."""
    _all = W.partitionBy()
    order = W.orderBy(F.col("_source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                          F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))) + 1)
    s = sizes.withColumns({"w": weight, "cap": F.col("source_size") * F.lit(float(limit)),
                           "goal": F.sum("source_size").over(_all) * F.lit(share)})
    by_room = W.orderBy(F.col("cap") / F.col("w"), F.col("_source").asc_nulls_last())
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0.0)
    s = s.withColumns({"level": (F.col("goal") - F.coalesce(F.sum("cap").over(before), zero))
                       / (F.sum("w").over(_all) - F.coalesce(F.sum("w").over(before), zero)),
                       "at": F.row_number().over(by_room)})
    first = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("at", "level"))).over(_all)
    return s.select("_source", "source_size", F.least(
        "cap", F.coalesce(first["level"] * F.col("w"), F.col("cap"))).alias("target"))


def _small(df: DataFrame) -> DataFrame:
    """One row per source (and size class): broadcast behind a check of its size."""
    return F.broadcast(df) if is_broadcastable(df) else df


def _key(source: str = "_source") -> Column:
    """A source as a join key that equals itself when null."""
    return F.concat(F.when(F.col(source).isNull(), "n").otherwise("s"), F.coalesce(F.col(source), F.lit("")))


def _expected(lean: DataFrame, cycle, share: float, limit: int) -> DataFrame:
    """``_key, _class, source_size, target, whole, p, rest``: copies by source and size class."""
    classes = lean.groupBy("_source", "_class").agg(F.sum("_size").alias("words"))
    goals = targets(classes.groupBy("_source").agg(F.sum("words").alias("source_size")), cycle, share, limit)
    c = (classes.withColumn("_key", _key())
         .join(goals.withColumn("_key", _key()).drop("_source"), "_key")
         .withColumn("g", F.expr("cast(shiftleft(1L, _class) AS double)")))
    large_first = W.partitionBy("_key").orderBy(F.col("_class").desc())
    before = large_first.rowsBetween(W.unboundedPreceding, -1)
    onward = large_first.rowsBetween(0, W.unboundedFollowing)
    lim = F.lit(float(limit))
    c = c.withColumn("c", F.try_divide(
        F.col("target") - F.coalesce(F.sum(F.col("words") * lim).over(before), F.lit(0.0)),
        F.sum(F.col("g") * F.col("words")).over(onward)))
    own = W.partitionBy("_key")
    first = F.min(F.when(F.col("c") * F.col("g") <= lim, F.struct(-F.col("_class"), F.col("c").alias("c")))).over(own)
    copies = F.least(lim, F.coalesce(first["c"] * F.col("g"), lim))
    c = c.withColumn("copies", copies).withColumns({
        "whole": F.floor("copies").cast("int"), "p": F.col("copies") - F.floor("copies")})
    return c.withColumn("rest", F.col("target") - F.sum(F.col("whole") * F.col("words")).over(own)).select(
        "_key", "_class", "source_size", "target", "whole", "p", "rest")


def _ranked(frame: DataFrame, expected: DataFrame) -> DataFrame:
    """``frame`` with its class's row of ``expected`` and the rank ``_v``: odds of u over odds of p, as q / (1 + q)."""
    q = (F.col("_u") / (1 - F.col("_u"))) * ((1 - F.col("p")) / F.col("p"))
    drawn = (F.col("p") > 0) & (F.col("_size") > 0)
    return (frame.withColumn("_key", _key()).join(_small(expected), ["_key", "_class"])
                 .withColumn("_q", F.when(drawn, q)).withColumn("_v", F.col("_q") / (1 + F.col("_q"))))


def _bucket(level: int) -> Column:
    """The rank's bucket among BUCKETS ** level equal parts of (0, 1)."""
    return F.floor(F.col("_v") * BUCKETS ** level)


def _cut_bucket(near: DataFrame, level: int) -> DataFrame:
    """Per source, the bucket in which the running total passes ``rest``, and the total before it."""
    sums = near.groupBy("_key", _bucket(level).alias("bucket"), "spent", "rest").agg(F.sum("_size").alias("words"))
    upto = F.sum("words").over(W.partitionBy("_key").orderBy("bucket")) + F.col("spent")
    return (sums.withColumn("upto", upto).filter(F.col("upto") > F.col("rest")).groupBy("_key")
                .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("spent"))).alias("b"))
                .select("_key", "b.bucket", "b.spent"))


def _cuts(ranked: DataFrame) -> DataFrame:
    """``_key, bucket, cut, last_row``: the finest bucket that holds the cut, the last (rank, id, size) that
    the source takes in it, and the last row of that rank if not all of them are taken; no row for a source that takes all that are ranked."""
    ranked = ranked.filter(F.col("_v").isNotNull())
    near = ranked.withColumn("spent", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        found = stored(_cut_bucket(near, level), "mix-cut")
        near = ranked.join(_small(found), "_key").filter(_bucket(level) == F.col("bucket"))
    # Rows alike in id and text share a rank; they are counted first, and the cut may fall between them.
    groups = near.groupBy("_key", "_v", "_id", "_size", "spent", "rest").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum(F.col("m") * F.col("_size")).over(
        W.partitionBy("_key").orderBy("_v", "_id", "_size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) + F.col("spent")
    some = F.least("m", F.floor((F.col("rest") - before) / F.col("_size") + 0.5))
    last = stored(groups.withColumn("t", some).filter("t > 0").groupBy("_key")
                        .agg(F.max(F.struct("_v", "_id", "_size", "t", "m")).alias("g"))
                        .select("_key", F.struct("g._v", "g._id", "g._size").alias("cut"), "g.t", "g.m"), "mix-last")
    return found.join(last, "_key", "left").join(_last_rows(near, last.filter("t < m")), "_key", "left") \
        .select("_key", "bucket", "cut", "last_row")


def _last_rows(near: DataFrame, partial: DataFrame) -> DataFrame:
    """``_key, last_row``: the number of the last of the ``t`` rows that are taken of the group at the
    cut. Rows are counted by the partition they were read in, and ordered in one partition only."""
    rows = near.select("_key", "_v", "_id", "_size", "_row", F.shiftright("_row", 33).alias("part")) \
        .join(_small(partial), "_key").filter(F.struct("_v", "_id", "_size") == F.col("cut")).select("_key", "_row", "part", "t")
    parts = rows.groupBy("_key", "part", "t").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(W.partitionBy("_key").orderBy("part"))
    at = parts.withColumn("upto", upto).filter((F.col("upto") >= F.col("t")) & (F.col("upto") - F.col("n") < F.col("t"))) \
        .select("_key", "part", (F.col("t") - F.col("upto") + F.col("n")).alias("nth"))
    place = F.row_number().over(W.partitionBy("_key").orderBy("_row"))
    return rows.join(_small(stored(at, "mix-parts")), ["_key", "part"]).withColumn("place", place) \
        .filter(F.col("place") == F.col("nth")).select("_key", F.col("_row").alias("last_row"))


def with_copies(frame: DataFrame, doc_id: str, text: str, source: str, cycle=CYCLE, share: float = SHARE,
                limit: int = LIMIT, seed: str = SEED, drop: tuple = ()) -> DataFrame:
    """``frame`` (without the columns ``drop``) plus ``_size, source_size, target`` and ``_copies``.

    The rows are stored with their sizes, draws and numbers, so that every step sees the same ones."""
    drawn = stored(_drawn(frame, doc_id, text, source, seed).withColumn("_row", F.monotonically_increasing_id()).drop(*drop),
                   "mix-rows")
    lean = drawn.select("_source", "_id", "_size", "_class", "_u", "_row")
    expected = stored(_expected(lean, cycle, share, limit), "mix-expected")
    cuts = stored(_cuts(_ranked(lean, expected)), "mix-cuts")
    fine, cut = _bucket(LEVELS), F.col("bucket")
    rank = F.struct("_v", "_id", "_size")
    inside = F.coalesce(rank < F.col("cut"), F.lit(False)) | (F.coalesce(rank == F.col("cut"), F.lit(False))
                                                             & F.coalesce(F.col("_row") <= F.col("last_row"), F.lit(True)))
    more = F.when(F.col("_v").isNull(), False).when(cut.isNull() | (fine < cut), True).otherwise((fine == cut) & inside)
    return (_ranked(drawn, expected).join(_small(cuts), "_key", "left")
            .withColumn("_copies", F.when(F.col("_size") > 0, F.col("whole") + more.cast("int")).otherwise(0)))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        **how) -> DataFrame:
    """The mix: every row of ``docs`` as often as it is taken, columns unchanged.

    Null and empty texts have no words and are not taken. The null source is a source of its
    own, last in order. Ranks are a hash of id and text, so reruns agree; of rows alike in both as
    many are taken as the target wants, whichever they are. Texts of any length are counted whole.
    Extra columns may clash with any name used here. An empty table gives an empty mix.
    """
    p = Positional(docs)
    out = with_copies(p.frame, p[id_col], p[text_col], p[source_col], **how)
    return p.restore(out.filter("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))))


def op3(docs: DataFrame) -> DataFrame:
    out = with_copies(pick(docs, doc_id="doc_id", t="text", s="source"), "doc_id", "t", "s", drop=("t",))
    return out.select("doc_id", F.col("_size").alias("size"), F.col("source_size"), "target",
                      (F.col("_copies") * F.col("_size")).cast("long").alias("taken"),
                      F.col("_copies").cast("int").alias("copies"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, source, CAST(len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
             (CAST(CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || t), 1, 13)
                   AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u FROM d),
e AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) // 2 ELSE 0 END AS k FROM b),
s AS (SELECT source, CAST(sum(size) AS DOUBLE) AS total FROM e GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE
                ELSE 1.0::DOUBLE END AS w, total * 2.0::DOUBLE AS cap, (sum(total) OVER ()) * 1.5::DOUBLE AS goal FROM s),
l AS (SELECT *, (goal - coalesce(sum(cap) OVER z, 0.0::DOUBLE)) / ((sum(w) OVER ()) - coalesce(sum(w) OVER z, 0.0::DOUBLE)) AS lev,
             row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rk
      FROM w WINDOW z AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, total, least(cap, coalesce((SELECT arg_min(lev, rk) FROM l WHERE lev * w <= cap) * w, cap)) AS target FROM l),
c AS (SELECT source, k, CAST(sum(size) AS DOUBLE) AS words, CAST(CAST(1 AS BIGINT) << k AS DOUBLE) AS g FROM e GROUP BY source, k),
m AS (SELECT c.*, t.total, t.target, CASE WHEN sum(g * words) OVER y = 0 THEN NULL ELSE
             (target - coalesce(sum(words * 2.0::DOUBLE) OVER z, 0.0::DOUBLE)) / (sum(g * words) OVER y) END AS f
      FROM c JOIN t ON c.source IS NOT DISTINCT FROM t.source
      WINDOW z AS (PARTITION BY c.source ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             y AS (PARTITION BY c.source ORDER BY k DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
x AS (SELECT source, arg_max(f, k) AS f FROM m WHERE f * g <= 2 GROUP BY source),
n AS (SELECT m.*, least(2.0::DOUBLE, coalesce(x.f * g, 2.0::DOUBLE)) AS copies
      FROM m LEFT JOIN x ON m.source IS NOT DISTINCT FROM x.source),
q AS (SELECT *, target - sum(floor(copies) * words) OVER (PARTITION BY source) AS rest, copies - floor(copies) AS p FROM n),
v AS (SELECT e.*, q.total, q.target, q.rest, floor(q.copies) AS whole,
             CASE WHEN p > 0 AND size > 0 THEN (u / (1 - u)) * ((1 - p) / p) END AS o
      FROM e JOIN q ON e.source IS NOT DISTINCT FROM q.source AND e.k = q.k),
r AS (SELECT *, sum(size) OVER (PARTITION BY source, o IS NULL ORDER BY o / (1 + o), doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 <= rest AS more FROM v),
a AS (SELECT *, CASE WHEN size > 0 THEN CAST(whole AS INTEGER) + CASE WHEN o IS NOT NULL AND more THEN 1 ELSE 0 END ELSE 0 END AS copies FROM r)
SELECT doc_id, size, CAST(total AS BIGINT) AS source_size, target, CAST(copies * size AS BIGINT) AS taken,
       CAST(copies AS INTEGER) AS copies FROM a
"""
