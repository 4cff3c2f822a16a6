"""Profile parts by day: replaced days equal a rebuild, and only touched buckets are read and written."""

import pytest

from adlens.plans.profile_store import WEIGHTS, ProfileStore


def _rows(frame):
    return {(r.user_key, r.kind, r.tag): r.weight for r in frame.collect()}


def _sum(*days):
    out = {}
    for day in days:
        for u, k, t, w in day:
            out[u, k, t] = out.get((u, k, t), 0) + w
    return {k: w for k, w in out.items() if w}


A = [("u1", "ad", "LC01", 2), ("u2", "ad", "LC01", 1), ("u3", "app", "APPx", 5), ("u1", "ad", "LC01", 1)]
B = [("u1", "ad", "LC02", 7), ("u4", "keyword", "Kx", 1)]
C = [("u2", "ad", "LC01", 4)]


def test_days_add_up_and_are_replaced(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"), 16)
    frame = lambda rows: spark.createDataFrame(rows, WEIGHTS)
    assert _rows(store.weights()) == {}
    store.put("20190921", frame(A))
    store.put("20190922", frame(B))
    assert _rows(store.weights()) == _sum(A, B)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "p" / "total").rglob("*.parquet")}
    store.put("20190921", frame(A[:2] + C))
    assert _rows(store.weights()) == _sum(A[:2] + C, B) and store.days() == ["20190921", "20190922"]
    untouched = {f for f in files if int(f.parent.name.partition("=")[2]) not in store.merged_buckets}
    assert untouched and all(f.stat().st_mtime_ns == files[f] for f in untouched)
    assert _rows(store.user("u1")) == {k: w for k, w in _sum(A[:2] + C, B).items() if k[0] == "u1"}
    store.put("20190921", frame([]))
    assert _rows(store.weights()) == _sum(B)


def test_a_put_that_did_not_end_is_made_good_by_the_next(spark, tmp_path):
    store = ProfileStore(spark, str(tmp_path / "p"), 4)
    frame = lambda rows: spark.createDataFrame(rows, WEIGHTS)
    store.put("d1", frame(A))
    store.day("d2").write(frame(B), 2)
    with pytest.raises(RuntimeError):
        store.weights()
    store.put("d2", frame(B))
    assert _rows(store.weights()) == _sum(A, B)
