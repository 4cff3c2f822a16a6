"""Component labels kept up to date: equal to a full run after every increment, and bounded reads."""

import random
import re
from pathlib import Path

import pytest

from adlens.operators.component_store import ComponentStore
from adlens.operators.components import connected_components


def _pairs(frame):
    return {tuple(r) for r in frame.collect()}


@pytest.mark.parametrize("id_type, days", [("string", 3), ("bigint", 2)])
def test_increments_equal_a_full_run(spark, tmp_path, id_type, days):
    rng = random.Random(5)
    name = (lambda k: f"id{k:03d}") if id_type == "string" else (lambda k: k)
    schema = f"src {id_type}, dst {id_type}"
    store = ComponentStore(spark, str(tmp_path / "s"), id_type, 8)
    seen = []
    for day in range(1, days + 1):
        new = [(name(rng.randrange(120)), name(rng.randrange(120))) for _ in range(25)] + [(name(200 + day),) * 2, (None, name(3))]
        before = dict(_pairs(store.labels())) if day > 1 else {}
        store.apply(spark.createDataFrame(new, schema), day)
        seen += new
        full = dict(_pairs(connected_components(spark.createDataFrame(seen, schema))))
        assert dict(_pairs(store.labels())) == full
        assert _pairs(store.renames(day)) == {(c, full[c]) for c in set(before.values()) if full[c] != c}
    if days < 3:
        return
    assert store.store.versions() == [1, 2, 3]
    store.compact(5)
    assert dict(_pairs(store.labels())) == full and store.store.versions() == [5]
    store.apply(spark.createDataFrame([(name(200 + 1), name(0))], schema), 6)
    seen.append((name(201), name(0)))
    assert dict(_pairs(store.labels())) == dict(_pairs(connected_components(spark.createDataFrame(seen, schema))))


def test_untouched_components_are_neither_read_nor_written(spark, tmp_path):
    store = ComponentStore(spark, str(tmp_path / "s"), buckets=64)
    edges = [(f"a{i}", f"a{i + 1}") for i in range(50)] + [("x1", "x2"), ("y1", "y2")]
    store.apply(spark.createDataFrame(edges, "src string, dst string"), 1)
    files = {f: f.stat().st_mtime_ns for f in Path(tmp_path).rglob("*.parquet")}
    store.read_buckets.clear()
    store.apply(spark.createDataFrame([("x2", "y2")], "src string, dst string"), 2)
    assert _pairs(store.store.read([2]).select("id", "parent")) == {("y1", "x1"), ("y2", "x1")}
    wanted = {r[0] for r in spark.createDataFrame([(k,) for k in ("x1", "x2", "y1", "y2")], "id string")
              .select(store.store.bucket("id")).collect()}
    assert store.read_buckets == wanted and len(wanted) <= 4
    plan = store.store.read([1], wanted)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", plan)
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())


def test_a_version_can_run_again_but_not_late(spark, tmp_path):
    store = ComponentStore(spark, str(tmp_path / "s"))
    frame = lambda *e: spark.createDataFrame(list(e), "src string, dst string")
    store.apply(frame(("b", "c")), 1)
    store.apply(frame(("a", "b")), 2)
    store.apply(frame(("c", "d")), 2)
    assert dict(_pairs(store.labels())) == {"b": "b", "c": "b", "d": "b"}
    with pytest.raises(ValueError):
        store.apply(frame(("x", "y")), 1)


def test_a_version_without_its_marker_does_not_count(spark, tmp_path):
    store = ComponentStore(spark, str(tmp_path / "s"))
    frame = lambda *e: spark.createDataFrame(list(e), "src string, dst string")
    store.apply(frame(("b", "c")), 1)
    store.apply(frame(("a", "b")), 2)
    (tmp_path / "s" / "v=2" / "_SUCCESS").unlink()
    assert dict(_pairs(store.labels())) == {"b": "b", "c": "b"}
    store.apply(frame(), 2)
    assert dict(_pairs(store.labels())) == {"b": "b", "c": "b"}
