"""Periodic runs: against all periods at all places, and the query's digests against plain Python."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, odd_rows

from adlens.llm import runs
from adlens.llm.common import read_table


def brute_runs(w):
    n, out, number = len(w), set(), {}
    s = np.array([number.setdefault(x, len(number)) for x in w])
    for q in range(1, n // 4 + 1):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], s[:-q] == s[q:], [0]])))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist()):
            size = j - i + q
            if size >= max(6, 4 * q) and not any((s[i:i + size - z] == s[i + z:i + size]).all() for z in range(1, q)):
                out.add((i, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    return (doc_id, len(found), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


periodic = st.builds(lambda head, unit, times, tail: head + (unit * times)[:len(unit) * times - len(tail) % 3] + tail,
                     st.lists(st.integers(0, 2), max_size=9), st.lists(st.integers(0, 2), min_size=1, max_size=7),
                     st.integers(0, 9), st.lists(st.integers(0, 2), max_size=9))


@settings(max_examples=300, deadline=None)
@given(st.lists(periodic | st.lists(st.integers(0, 1), max_size=60), max_size=5))
def test_runs_match_all_periods(texts):
    assert runs.find_runs(texts) == [brute_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=2, max_size=80), st.data())
def test_grammar_extensions_match_symbol_by_symbol(s, data):
    g = runs.Grammar(np.array([*s, 9]))
    pairs = data.draw(st.lists(st.tuples(st.integers(0, len(s)), st.integers(0, len(s))).filter(lambda p: p[0] != p[1]),
                               min_size=1, max_size=20))
    full = [*s, 9]

    def plain(i, j):
        k = 0
        while max(i, j) + k < len(full) and full[i + k] == full[j + k]:
            k += 1
        return k
    got = g.lce(*(np.array(x) for x in zip(*pairs)))
    assert got.tolist() == [plain(i, j) for i, j in pairs]


def test_long_texts_and_blocks_of_points(monkeypatch):
    monkeypatch.setattr(runs, "GRID_POINTS", 1000)
    text = [k * k % 9973 for k in range(3000)] + [1, 2, 3] * 2000 + ["a"] * 5000
    assert runs.find_runs([text, ["a"] * 7, []]) == [brute_runs(text[:10]) + [(3000, 6000, 3), (9000, 5000, 1)], [(0, 7, 1)], []]


def test_odd_rows_and_empty_table(spark, odd, empty):
    want = sorted(str(brute_row(r[0], r[1])) for r in odd_rows())
    assert sorted(str(tuple(r)) for r in runs.op11(odd).collect()) == want
    assert runs.op11(empty).collect() == []


def test_query_on_the_small_table(spark):
    docs = read_table(spark, SF, "documents")
    want = sorted(brute_row(r.doc_id, r.text) for r in docs.collect())
    got = sorted(tuple(r) for r in runs.op11(docs).collect())
    assert got == want and sum(r[1] > 0 for r in got) > 10
