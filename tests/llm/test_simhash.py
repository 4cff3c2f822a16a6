"""SimHash: fingerprints bit by bit, links against all pairs, components, hot groups."""

import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, odd_rows
from pyspark.sql import functions as F

from adlens.llm import simhash
from adlens.llm.common import read_table


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints):
    part = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2 and part[i] != part[j]:
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: min((ids[i] for i in range(len(ids)) if part[i] == p and ids[i] is not None), default=None) for p in part}
    return [least[p] for p in part]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), min_size=1, max_size=60), st.integers(0, 3), st.booleans())
def test_trie_pairs_match_all_pairs(seeds, most, near):
    values = {s ^ (1 << k) ^ (1 << j) for s in seeds[:6] for k in range(0, 64, 7) for j in range(0, 64, 13)} if near else set(seeds)
    a = np.array(sorted(values), np.uint64)
    want = {(i, j) for i in range(len(a)) for j in range(i + 1, len(a)) if (int(a[i]) ^ int(a[j])).bit_count() <= most}
    got = [(int(i), int(j)) for x, y in simhash.trie_pairs(a, a, 0, most, True) for i, j in zip(x, y)]
    assert len(got) == len(set(got)) and {tuple(sorted(p)) for p in got} == want


def test_odd_rows_and_empty_table(spark, odd, empty):
    rows = odd_rows()
    prints = [brute_print(r[1]) for r in rows]
    want = sorted(map(str, zip([r[0] for r in rows], [f"{p:016x}" for p in prints],
                               brute_components([r[0] for r in rows], prints))))
    got = sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in simhash.op5(odd).collect())
    assert got == want
    assert simhash.op5(empty).count() == 0 and simhash.keep_one(empty).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    components = brute_components([r[0] for r in rows], prints)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(set(components), key=str)


def test_upper_trie_levels_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (40, 30, 3), dtype=np.uint64)).astype(np.uint64)
    # Most share their first 20 bits, so that one prefix is hot.
    hot = (np.uint64(0xABCDE) << np.uint64(44)) | rng.integers(0, 2 ** 16, 700, dtype=np.uint64)
    values = np.unique(np.r_[centre, (centre[:, None] ^ np.bitwise_xor.reduce(flips, axis=2)).ravel(), hot])
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    got = {tuple(sorted((r.a, r.b))) for r in simhash.hamming_links(frame, 2, task_rows=64).collect()}
    near = np.bitwise_count(values[:, None] ^ values) <= 2
    i, j = np.nonzero(np.triu(near, 1))
    signed = values.view(np.int64)
    assert got == {tuple(sorted((int(signed[x]), int(signed[y])))) for x, y in zip(i, j)}


def test_whole_documents(spark):
    docs = read_table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], brute_components([r.doc_id for r in rows], prints)))
    got = simhash.op5(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(rows)
    assert docs.groupBy("text").agg(F.collect_list("doc_id").alias("g")).filter("size(g) > 1").count() > 0
