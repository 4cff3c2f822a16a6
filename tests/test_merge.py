"""Bounded list building: chunks cover every item exactly once and stay bounded."""

from pyspark.sql import functions as F

from adlens.operators.merge import chunked_collect, profile_chunks, profile_map


def test_chunked_collect_splits_hot_key(spark):
    rows = [("hot", f"t{i:05d}") for i in range(5000)] + [("cold", "a"), ("cold", "b")]
    df = spark.createDataFrame(rows, "k string, item string")
    out = chunked_collect(df, ["k"], F.col("item"), F.col("item"), chunk_size=500).collect()
    hot = [r for r in out if r["k"] == "hot"]
    cold = [r for r in out if r["k"] == "cold"]
    assert len(cold) == 1 and cold[0]["items"] == ["a", "b"] and cold[0]["chunk"] == 0
    assert len(hot) == 10
    items = [x for r in hot for x in r["items"]]
    assert sorted(items) == [f"t{i:05d}" for i in range(5000)]
    assert all(r["items"] == sorted(r["items"]) for r in hot)
    assert max(r["n_items"] for r in hot) < 800


def test_profile_rendering(spark):
    w = spark.createDataFrame([("u", "LN ", 1), ("u", "LN", 2), ("u", "K女流氓", 2)],
                              "user_key string, tag string, weight bigint")
    r = profile_chunks(w, "user_key").first()
    assert r["tags"] == "(K女流氓,2),(LN,2),(LN ,1)"
    assert r["n_tags"] == 3


def test_hot_key_is_dealt_by_key_and_chunk(spark):
    w = spark.range(50_000).select(F.when(F.col("id") % 4 < 3, "hot").otherwise(F.col("id").cast("string")).alias("k"),
                                   F.concat(F.lit("t"), F.col("id").cast("string")).alias("item"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1",  # as if the counts were many
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = chunked_collect(w.checkpoint(), ["k"], F.col("item"), F.col("item"), chunk_size=500, max_broadcast_rows=0)
        plan = out._jdf.queryExecution().executedPlan().toString()
        spread = out.filter("k = 'hot'").groupBy(F.spark_partition_id()).count().count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert any("k#" in x and "chunk#" in x for x in exchanges)
    # Both sides of the join with the counts come from stored tables, so AQE may split the hot key.
    assert sum("k#" in x and "chunk#" not in x for x in exchanges) == 2
    assert spread > 1


def test_one_text_of_two_kinds_is_one_tag(spark):
    w = spark.createDataFrame([("u", "business", "ZPx", 2), ("u", "location", "ZPx", 3), ("u", "ad", "LC01", 1)],
                              "user_key string, kind string, tag string, weight bigint")
    assert profile_chunks(w, "user_key").first()["tags"] == "(LC01,1),(ZPx,5)"
    assert profile_map(w, "user_key").first()["profile"] == {"LC01": 1, "ZPx": 5}
