"""The heaviest tags: exact with a user that holds a third of all tags, ties by name, a bound below the exchange."""

from pyspark.sql import functions as F

from adlens.operators.merge import top_tags


def _weights(spark):
    n = spark.range(9000).repartition(8)
    user = F.when(F.col("id") % 3 == 0, F.lit("anonymous")).otherwise(F.concat(F.lit("u"), (F.col("id") % 700).cast("string")))
    return n.select(user.alias("user_key"), F.concat(F.lit("k"), (F.col("id") % 2).cast("string")).alias("kind"),
                    F.concat(F.lit("t"), F.col("id").cast("string")).alias("tag"), (F.col("id") * 7919 % 50).alias("weight"))


def test_equal_to_a_sort(spark):
    rows = [tuple(r) for r in _weights(spark).collect()]
    for kind in (False, True):
        groups = {}
        for u, k, t, w in rows:
            groups.setdefault((u, k) if kind else u, []).append((-w, k, t, u))
        want = {(u, k, t, -w, i + 1) for g in groups.values() for i, (w, k, t, u) in enumerate(sorted(g)[:4])}
        got = [tuple(r) for r in top_tags(_weights(spark), "user_key", 4, kind).collect()]
        assert len(got) == len(want) and set(got) == want


def test_the_bound_is_below_the_exchange(spark):
    plan = top_tags(_weights(spark), "user_key", 4)._jdf.queryExecution().executedPlan().toString()
    nodes = [line.strip(" +-:*()0123456789").split(" ")[0] for line in plan.splitlines()]
    limits = [i for i, n in enumerate(nodes) if n == "WindowGroupLimit"]
    exchange = next(i for i, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(user_key" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]
