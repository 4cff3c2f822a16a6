"""The Jaccard join: region recursion and its Spark rounds against all pairs, and the whole result."""

import random
import re

import numpy as np
import pytest
from llm_fixtures import SF, odd_rows

from adlens.llm import jaccard
from adlens.llm.common import read_table


def brute_sets(texts):
    out = []
    for text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out.append({tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set())
    return out


def brute_parts(sets, percent=85):
    part = list(range(len(sets)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both) and root(i) != root(j):
                    part[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


def brute(rows):
    sets = brute_sets([t for _, t in rows])
    parts = brute_parts(sets)
    least = {p: min((r[0] for r, q in zip(rows, parts) if p == q and r[0] is not None), default=None) for p in set(parts)}
    return sorted(str((r[0], len(s), least[p])) for r, s, p in zip(rows, sets, parts))


def family(rng, size, vocabulary, spread, count):
    base = [rng.randrange(vocabulary) for _ in range(size)]
    out = []
    for _ in range(count):
        s = list(base)
        for _ in range(rng.randint(0, spread)):
            s[rng.randrange(size)] = rng.randrange(vocabulary)
        out.append(np.unique(np.array(s, np.int64)))
    return out


def same_parts(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


@pytest.mark.parametrize("seed", range(12))
def test_region_links_match_all_pairs(seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(jaccard, "LEAF", rng.choice([2, 5, 24]))
    monkeypatch.setattr(jaccard, "PIVOTS", rng.choice([2, 4, 24]))
    sets = [s for _ in range(rng.randint(1, 12)) for s in family(rng, rng.choice([6, 20, 60]), rng.choice([80, 10 ** 6]),
                                                                  rng.choice([1, 3, 12, 30]), rng.randint(1, 40))]
    rng.shuffle(sets)
    links = jaccard.region_links(sets)
    part = list(range(len(sets)))
    for i, j in links:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both)
        part = [part[i] if p == part[j] else p for p in part]
    assert same_parts(part, brute_parts([set(s.tolist()) for s in sets]))


@pytest.mark.parametrize("near", [True, False])
def test_large_regions_run_as_spark_rounds(spark, near):
    rng = random.Random(3)
    sets = family(rng, 60, 10 ** 6, 8, 150) if near else \
        [s for _ in range(6) for s in family(rng, 40, 90, 6, 20)] + family(rng, 40, 10 ** 6, 20, 60)
    rows = spark.createDataFrame([("r", 10 * i, len(s), None, s.tolist()) for i, s in enumerate(sets)],
                                 "region string, pt long, n int, label long, grams array<long>")
    part = list(range(len(sets)))
    for r in jaccard.metric_links(rows, 85, 1500).collect():
        part = [part[r.a // 10] if p == part[r.b // 10] else p for p in part]
    assert same_parts(part, brute_parts([set(s.tolist()) for s in sets]))


def test_odd_rows_and_empty_table(spark, odd, empty):
    got = sorted(str(tuple(r)) for r in jaccard.op12(odd).collect())
    assert got == brute([r[:2] for r in odd_rows()])
    assert jaccard.op12(empty).collect() == []


def test_query_on_the_small_table(spark):
    docs = read_table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = jaccard.op12(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows) and sum(r.component_id != r.doc_id for r in got) > 5
