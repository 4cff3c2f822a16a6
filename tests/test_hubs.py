"""Hub ids: exact degrees, thresholds by kind, days' sketches, and people that a placeholder no longer fuses."""

from pyspark.sql import functions as F

from adlens.operators import hubs as H
from adlens.operators.components import connected_components


def _lists(spark, people=60):
    rows = [[f"IM{i}", f"AD{i}", "IM000000"] for i in range(people)] + [[f"AD{i}", f"MC{i // 4}"] for i in range(people)]
    rows += [["IM000000"], [], ["IM000000", "OD1", "ID1"], ["ID1", "ID2"]]
    return spark.createDataFrame([(r,) for r in rows], "ids array<string>")


def test_degrees_are_exact_and_thresholds_go_by_kind(spark):
    got = {(r.id, r.kind, r.degree) for r in H.hub_ids(_lists(spark), {"MC": 4, "AD": 3}, 50).collect()}
    assert got == {("IM000000", "IM", 122)} | {(f"MC{k}", "MC", 4) for k in range(15)} | {(f"AD{i}", "AD", 3) for i in range(60)}


def test_sketches_of_days_merge(spark):
    lists = _lists(spark).withColumn("day", F.monotonically_increasing_id() % 3)
    parts = [H.degree_sketches(lists.filter(f"day = {d}")) for d in range(3)]
    merged = H.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    got = {r.id: r.degree for r in H.hub_ids(lists, default=50, sketches=merged).collect()}
    assert got == {"IM000000": 122}


def test_a_placeholder_no_longer_fuses_people(spark):
    lists = _lists(spark)
    hubs = H.hub_ids(lists, default=50)
    labels = {r.id: r.component for r in connected_components(H.edges_without(lists, hubs)).collect()}
    assert "IM000000" not in labels and labels["OD1"] == labels["ID1"] == labels["ID2"] == "ID1"
    assert all(labels[f"IM{i}"] == labels[f"AD{i}"] == labels[f"AD{i // 4 * 4}"] for i in range(60))
    assert len(set(labels.values())) == 16
    heads = {tuple(r.ids): r.head for r in H.kept_heads(lists, hubs).collect()}
    assert heads[("IM000000", "OD1", "ID1")] == "OD1" and ("IM000000",) not in heads and () not in heads


def test_no_hubs_and_an_empty_log(spark):
    lists = _lists(spark)
    none = H.hub_ids(lists, default=10_000)
    assert none.collect() == [] and H.edges_without(lists, none).filter("src = dst").count() == 60 + 60 + 15 + 4
    assert H.hub_ids(lists.limit(0)).collect() == []
