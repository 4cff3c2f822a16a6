"""Connected components: the people-graph golden, properties and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from adlens.operators.components import connected_components
from adlens.plans.profiles import component_members

# FIXED VALUES: the worked example of identity resolution, people and links.
PEOPLE = [(1, "小明", 26), (2, "小红", 30), (6, "小黑", 33), (9, "小白", 26), (133, "小黄", 30),
          (138, "小蓝", 33), (158, "小绿", 26), (16, "小龙", 30), (44, "小强", 33), (21, "小胡", 26),
          (5, "小狗", 30), (7, "小熊", 33)]
EDGES = [(1, 133), (2, 133), (6, 133), (9, 133), (6, 138), (16, 138), (21, 138), (44, 138),
         (5, 158), (7, 158)]


def _labels(df):
    return {r["id"]: r["component"] for r in df.collect()}


def _union_find(edges, nodes=()):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    for n in nodes:
        find(n)
    return {n: find(n) for n in parent}


def test_people_graph_golden(spark):
    edges = spark.createDataFrame(EDGES, "src bigint, dst bigint")
    got = _labels(connected_components(edges))
    assert got == {1: 1, 2: 1, 6: 1, 9: 1, 16: 1, 21: 1, 44: 1, 133: 1, 138: 1, 5: 5, 7: 5, 158: 5}


def test_people_graph_members(spark):
    edges = spark.createDataFrame(EDGES, "src bigint, dst bigint")
    people = spark.createDataFrame(PEOPLE, "id bigint, name string, age int")
    labels = connected_components(edges)
    rows = component_members(labels, people).collect()
    members = {r["component"]: sorted((m["name"], m["age"]) for m in r["members"]) for r in rows}
    assert members[5] == sorted([("小绿", 26), ("小熊", 33), ("小狗", 30)])
    assert len(members[1]) == 9 and ("小明", 26) in members[1]


def test_isolated_vertices_and_self_loops(spark):
    edges = spark.createDataFrame([("b", "b"), ("c", "a")], "src string, dst string")
    verts = spark.createDataFrame([("z",)], "id string")
    assert _labels(connected_components(edges, verts)) == {"a": "a", "b": "b", "c": "a", "z": "z"}


def _zigzag(n):
    """A path whose numbers alternate between low and high ones."""
    low, high = list(range(n // 2)), list(range(n // 2, n))
    return [x for pair in zip(low, reversed(high)) for x in pair]


@pytest.mark.parametrize("numbering", ["ascending", "descending", "random", "zigzag"])
def test_long_chains_converge_in_few_rounds(spark, numbering):
    n = 2000
    order = {"ascending": list(range(n)), "descending": list(range(n))[::-1], "zigzag": _zigzag(n),
             "random": random.Random(3).sample(range(n), n)}[numbering]
    edges = spark.createDataFrame(list(zip(order, order[1:])), "src bigint, dst bigint")
    stats = {}
    got = _labels(connected_components(edges, stats=stats))
    assert len(got) == n and set(got.values()) == {0}
    assert stats["rounds"] + stats["steps"] <= 40 and stats["rounds"] <= 12


def test_random_graphs_match_union_find_and_edge_order(spark):
    rng = random.Random(7)
    for trial in range(3):
        nodes = list(range(200))
        edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(150)]
        expect = _union_find(edges)
        df = spark.createDataFrame(edges, "src bigint, dst bigint")
        got = _labels(connected_components(df))
        assert got == expect
        shuffled = edges[::-1] + [(b, a) for a, b in edges]
        assert _labels(connected_components(spark.createDataFrame(shuffled, "src bigint, dst bigint"))) == expect


def test_hub_vertex(spark):
    # A placeholder id shared by many rows: one giant star plus a separate pair.
    edges = [("hub", f"id{i:04d}") for i in range(2000)] + [("x", "y")]
    got = _labels(connected_components(spark.createDataFrame(edges, "src string, dst string")))
    assert got["hub"] == "hub" and got["id0007"] == "hub" and got["y"] == "x"


def test_string_ids(spark):
    rng = random.Random(11)
    nodes = [f"id{i:03d}" for i in range(150)]
    edges = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(120)] + [("hub", n) for n in nodes[:40]]
    df = spark.createDataFrame(edges, "src string, dst string")
    assert _labels(connected_components(df)) == _union_find(edges)


def test_no_edges_and_null_ends(spark):
    edges = spark.createDataFrame([(None, 1), (2, None)], "src bigint, dst bigint")
    assert _labels(connected_components(edges)) == {}
    verts = spark.createDataFrame([(7,), (None,)], "id bigint")
    assert _labels(connected_components(edges, verts)) == {7: 7}


def test_round_tables_are_deleted(spark, tmp_path):
    from pathlib import Path

    from adlens.session import ensure_checkpoint_dir
    tables = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "tables"
    before = set(tables.glob("*")) if tables.exists() else set()
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)], "src bigint, dst bigint")
    assert connected_components(edges).count() == 51
    left = sorted(p.name.rsplit("-", 1)[0] for p in set(tables.glob("*")) - before)
    assert left == ["components"]


def test_deny_list_keeps_placeholder_ids_from_fusing_people(spark):
    from adlens import schema as S
    from adlens.plans.profiles import resolve_identities
    defaults = {"S": "", "I": 0, "D": 0.0}
    rows = []
    for u in range(5):
        r = {"imei": "000000000000000", "androidid": f"a{u}"}
        rows.append(tuple(r.get(n, defaults[k]) for n, k in S.LOG_COLUMNS))
    log = spark.createDataFrame(rows, S.LOG_SCHEMA)
    fused = _labels(resolve_identities(log))
    assert len(set(fused.values())) == 1
    kept = _labels(resolve_identities(log, deny_ids=["IM000000000000000"]))
    assert kept == {f"ADa{u}": f"ADa{u}" for u in range(5)}


def test_joins_of_a_round_split_a_hub(spark):
    from adlens.operators.components import _renamed
    from adlens.session import Scratch
    scratch = Scratch(spark)
    hub = spark.range(1, 60_001).select(F.when(F.col("id") < 40_000, 0).otherwise(F.col("id")).alias("a"),
                                        (F.col("id") + 100_000).alias("b"))
    edges, _ = scratch.write(hub, "edges")
    roots, _ = scratch.write(edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().select(
        "v", F.col("v").alias("p")), "roots")
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        out = _renamed(edges.repartition(20), roots)
        assert len(out.collect()) == 60_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
