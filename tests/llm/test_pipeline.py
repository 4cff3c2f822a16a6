"""The whole pipeline against plain Python, stage by stage, and the entry without it."""

import re
from collections import Counter

import public_tokenizers as P
from llm_fixtures import SF
from pyspark.sql import functions as F
from test_line_dedup import LOW, WS
from test_quality import brute as measures
from test_simhash import brute_components, brute_print

import corpus_pipeline
from adlens.llm import bpe, mixing
from adlens.llm.common import read_table


def test_stages_match_plain_python(spark):
    docs = read_table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}

    def good(t):
        n, chars, symbols, dup, rep = measures(t)
        lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (t or "").split("\n"))
        return n >= 50 and 100 * rep <= 50 * n and 10 * symbols <= n and 2 * dup <= lines and 2 * n <= chars <= 20 * n
    rows = {i: t for i, t in rows.items() if good(t)}
    first = {}
    for i in sorted(rows):
        for x in rows[i].split("\n"):
            first.setdefault(x.strip(WS).translate(LOW), i)
    rows = {i: "\n".join(x for x in t.split("\n") if len(k := x.strip(WS).translate(LOW)) < 10 or first[k] == i)
            for i, t in rows.items()}
    ids = sorted(rows)
    rows = {i: rows[i] for i, c in zip(ids, brute_components(ids, [brute_print(rows[i]) for i in ids])) if i == c}

    stage, seen = docs, {}
    for name, run in corpus_pipeline.STAGES[:3]:
        stage = run(spark, stage, SF)
        assert stage.columns == docs.columns
        seen[name] = stage
    left = {r.doc_id: r for r in stage.collect()}
    assert {i: r.text for i, r in left.items()} == rows
    assert all(r.n_chars == len(r.text) for r in left.values())

    copies = {r.doc_id: r.copies for r in mixing.op3(stage).collect()}
    enc = bpe.encoder(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter(r.doc_id for r in got) == Counter({i: n for i, n in copies.items() if n})
    assert all(r.ids == enc.encode_ordinary(rows[r.doc_id]) and r.n_tokens == len(r.ids) for r in got)


def test_stages_take_odd_and_empty_tables(spark, odd, empty):
    for frame in (odd, empty):
        stage = frame
        for _, run in corpus_pipeline.STAGES[:-1]:
            stage = run(spark, stage, SF)
            assert stage.columns == frame.columns
        out = corpus_pipeline.STAGES[-1][1](spark, stage, SF)
        assert out.agg(F.count("*")).first()[0] >= 0


def test_every_operator_is_registered():
    import __spark_entry__ as E
    names = E.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert {"op3_source_mix", "op8_quality_rules", "op10_line_dedup"} <= set(E.oracle_sql())
