"""Spelling variants: near words against all pairs, false positives, several passes, the whole result."""

import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SCHEMA, SF, odd_rows

from adlens.llm import spelling
from adlens.llm.common import read_table

LETTERS = [chr(int(c)) for c in spelling.ALPHABET]


def edits(w):
    cut = [(w[:i], w[i:]) for i in range(len(w) + 1)]
    return ({a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in LETTERS}
            | {a + c + b for a, b in cut for c in LETTERS}) - {w}


def brute(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    v = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in edits(w) if x in v] for w in v}
    form = {}
    for w in v:
        best = min(near[w], key=lambda x: (-v[x], x), default=None)
        form[w] = best if best and v[best] >= 5 * v[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, str(form[w]), root(w), n, len(near[w]), str(v.get(form[w]))) for w, n in v.items())


def rows_of(frame):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, str(r.form_n)) for r in frame.collect())


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abéÿ"), min_size=1, max_size=9))
def test_edit_hashes_are_the_hashes_of_the_edited_words(word):
    def plain(w):
        return int((spelling._points([w], len(w)) * spelling._powers(len(w))[:len(w)]).sum(dtype=np.uint64)) if w else 0
    for size, place, raw, kind in spelling._edits([word], len(word), 2 * len(LETTERS)):
        for at in np.ndindex(raw.shape[1:]):
            k = place + at[0]
            edit = word[:k] + (LETTERS[at[1]] if kind == "replaced" else "") + word[k + 1:]
            assert len(edit) == size and int(raw[(0, *at)]) == plain(edit)


def test_odd_rows_chains_ties_and_empty_table(spark, empty):
    base = ["letter", "lettér", "letters", "lettre", "xletters", "aaaaaaa", "aaaaaa", "b" * 300, "b" * 301, "short",
            "mmmmmm", "mmmmmz", "mmmmmy", "ÀÉÎÕÜß", "àéîõüß"]
    counts = [5, 25, 700, 6, 130, 5, 25, 5, 30, 90, 5, 25, 25, 40, 8]
    extra = [(1000 + i, f"{w.upper() if i % 2 and w.isascii() else w} " * n, "en", "s", 1, "x", 1, 1)
             for i, (w, n) in enumerate(zip(base, counts))]
    extra.append((None, "letter " * 3 + "lettes " * 9, None, None, None, None, None, None))
    frame = spark.createDataFrame(odd_rows() + extra, SCHEMA)
    want = brute([r[:2] for r in odd_rows() + extra])
    assert rows_of(spelling.op13(frame)) == want and any(f != "None" for _, f, *_ in want)
    assert spelling.op13(empty).collect() == []


def test_several_passes_give_the_same_pairs(spark):
    words = [f"w{a}{b}{c}xyz" for a in "abcdef" for b in "abcdefgh" for c in "abcdé"]
    frame = spark.createDataFrame([(w, 5 + i) for i, w in enumerate(words)], "word string, n long")
    want = {(w, x) for w in words for x in edits(w) if x in set(words)}
    for blocks in (1, 3, 1 << 10):
        got = [(r.word, r.near) for r in spelling.near_words(frame, blocks).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_query_on_the_small_table(spark):
    docs = read_table(spark, SF, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = rows_of(spelling.op13(docs))
    assert got == want and sum(r[1] != "None" for r in got) > 5
