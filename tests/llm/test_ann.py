"""Nearest neighbours: exact scores, recall against brute force, odd vectors, hot groups."""

import numpy as np
from llm_fixtures import SF

from adlens.llm import ann
from adlens.llm.common import read_table


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    order = [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k]
    return [(int(ids[i]), d[i]) for i in order]


def test_scan_alone_finds_nearly_all_and_never_lies():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 48))
    x[100:400] = x[7]  # a group of equal vectors
    ids, q = np.arange(3000) * 3, np.arange(0, 3000, 50)
    qn, vn, d = ann.adaptive_scan(x, ids, x[q], ids[q], 10, ann.rotation(48))
    hit = 0
    for i, row in enumerate(q):
        want = brute(ids, x, row, 10)
        got = [(int(ids[v]), s) for v, s in zip(vn[qn == i], d[qn == i])]
        assert len(got) == 10 and got == sorted(got, key=lambda t: (t[1], t[0]))
        assert all(np.isclose(s, np.sqrt(((x[v // 3] - x[row]) ** 2).sum()), rtol=1e-12) for v, s in got)
        hit += len({v for v, _ in got} & {v for v, _ in want})
    assert hit / (10 * len(q)) > 0.97
    near = [(int(ids[v]), s) for v, s in zip(vn[qn == 2], d[qn == 2])]
    assert q[2] == 100 and [v for v, _ in near] == [21, *(3 * i for i in range(101, 110))]


def test_embeddings_recall(spark):
    rows = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    data = rows.collect()
    ids, x = np.array([r.vec_id for r in data]), np.array([r.embedding for r in data], np.float64)
    got = {}
    for r in ann.op2(rows).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    queries = np.flatnonzero(ids % 100 == 0)
    assert set(got) == {int(ids[q]) for q in queries}
    hits = [len({v for v, _ in brute(ids, x, q, 10)} & {v for _, v, _ in got[int(ids[q])]}) for q in queries]
    assert np.mean(hits) / 10 >= 0.9
    assert all([r for r, _, _ in sorted(g)] == list(range(1, 11)) for g in got.values())


def test_odd_vectors_and_small_tables(spark):
    schema = "vec_id long, embedding array<float>, VEC_ID string, list int"
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0], "x", 1), (1, [1.0, 0.0], "x", 1), (2, [0.0, 1.0], "x", 1), (3, None, "x", 1),
            (4, [0.0, 0.0], "x", 1), (5, [None, 1.0], "x", 1), (6, [nan, 1.0], "x", 1), (7, [inf, 1.0], "x", 1),
            (None, [1.0, 1.0], "x", 1), (8, [1.0, 0.0], "x", 1), (8, [1.0, 0.0], "x", 1), (9, [1.0], "x", 1),
            (100, None, "x", 1), (200, [3.0, 0.0], "x", 1)]
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 6))
                 for r in ann.op2(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 1, 1, 0.0), (0, 2, 8, 0.0), (0, 3, 2, round(2 ** 0.5, 6)), (0, 4, 200, 2.0),
                   (200, 1, 0, 2.0), (200, 2, 1, 2.0), (200, 3, 8, 2.0), (200, 4, 2, round(10 ** 0.5, 6))]
    assert ann.op2(spark.createDataFrame([], schema)).count() == 0


def test_ids_with_several_vectors_and_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 5.0]), (0, [0.0, 5.0]), (1, [1.0, 0.5]), (2, [0.0, 5.5]), (2, [9.0, 9.0]),
            (100, [1.0, 1.0, 1.0]), (3, [1.0, 1.0, 2.0]), (4, [7.0]), (200, [1.0]), (200, [4.0, 4.0])]
    got = {}
    for r in ann.op2(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    distinct = sorted({(i, tuple(v)) for i, v in rows})
    for query in (0, 100, 200):
        mine = [v for i, v in distinct if i == query]
        want = sorted((min(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, q))) for q in mine if len(q) == len(v)), i)
                      for i, v in distinct if i != query and any(len(q) == len(v) for q in mine))
        assert [(v, s) for _, v, s in sorted(got.pop(query))] == [(i, d) for d, i in want]
    assert not got


def test_groups_of_lists_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP", 40)
    monkeypatch.setattr(ann, "QUERY_GROUP", 2)
    vectors = ann.usable(read_table(spark, SF, "embeddings"), "vec_id", "embedding")
    data = vectors.collect()
    ids, x = np.array([r.vec_id for r in data]), np.array([r.v for r in data], np.float64)
    got = ann.search(vectors, vectors.filter("vec_id % 100 = 0"), 10, probed=1.0).collect()
    pairs = {(r.query_id, r.vec_id) for r in got}
    want = {(int(ids[q]), v) for q in np.flatnonzero(ids % 100 == 0) for v, _ in brute(ids, x, q, 10)}
    assert len(pairs & want) >= 0.97 * len(want) and len(pairs) == len(want)
