"""Language model: base scores by hand, normalised probabilities, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
from llm_fixtures import odd_rows

from adlens.llm import lm
from adlens.llm.common import read_table


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in lm.tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        own = lm.tokens_of(t)
        out.append((i, held(i), len(own), sum(counts[w] > 0 for w in own), n,
                    sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)))
    return out


def _same(got, want):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=str)
    want = sorted(want, key=lambda r: str(r[:5]))
    got = sorted(got, key=lambda r: str(r[:5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)


def _vocabulary():
    return lm.Vocabulary({lm.END: 0, b"a": 1 + lm.CLASSES}, np.full(2 + lm.CLASSES, 1 / (2 + lm.CLASSES)),
                         np.full(lm.CLASSES, 3.0), 10, 4)


def test_probabilities_sum_to_one():
    v = _vocabulary()
    m = lm.Model.fresh(v)
    symbols = np.arange(v.size)
    logs = m.log_probabilities(symbols, np.full(v.size, 3), np.full(v.size, v.size))
    assert abs(np.exp(logs).sum() - 1) < 1e-5
    again = lm.Model.of(m.flat(), v.size)
    assert all((a == b).all() for a, b in zip(vars(m).values(), vars(again).values()))


def test_contexts_stop_at_text_borders():
    one, two = lm.contexts_of(np.array([5, 6, 7, 8, 9]), np.array([0, 3, 4]), 99)
    assert one.tolist() == [99, 5, 6, 99, 99] and two.tolist() == [99, 99, 5, 99, 99]


def test_training_learns_what_follows_what():
    v = _vocabulary()
    symbols = np.tile([3, 4, 5, 6, 7, 8], 3000)
    model, starts = lm.Model.fresh(v), np.array([0])
    for turn in range(30):
        lm.Trainer(model, v.unigram, turn).window(symbols, *lm.contexts_of(symbols, starts, v.size))
    logs = model.log_probabilities(symbols[2:], symbols[1:-1], symbols[:-2])
    assert logs.mean() > np.log(1 / v.size) + 2


def test_documents_and_held_out_gain(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = lm.op1(docs).collect()
    _same(got, brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)


def test_odd_rows_empty_table_and_no_training_rows(spark, odd, empty):
    _same(lm.op1(odd).collect(), brute([(r[0], r[1]) for r in odd_rows()]))
    assert lm.op1(empty).count() == 0
    ids = [i for i in range(100) if held(i)][:3]
    only = spark.createDataFrame([(i, "some words") for i in ids], "doc_id long, text string")
    rows = lm.op1(only).collect()
    assert len(rows) == 3 and all(r.n_known == 0 and r.base_score == 0 and math.isfinite(r.score) for r in rows)


def test_symbols_follow_the_vocabulary(spark):
    words = [f"w{i}" for i in range(40_000)]
    texts = [" ".join(words[k::50]) for k in range(50)] * 8
    ids = [i for i in range(1000) if not held(i)][:len(texts)]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(8)
    counts = lm._chunk_words(lm._chunked(docs)).groupBy("h").agg(lm.F.sum("n").alias("c"), lm.F.max("tail").alias("tail"))
    frequent = counts.withColumn("c", lm.F.when(lm.F.pmod("h", lm.F.lit(20)) == 0, 100).otherwise(lm.F.col("c")))
    vocabulary, _ = lm.vocabulary_of(frequent)
    # No chunk of a partition need hold 8 tokens of a word: the count of the whole table decides.
    assert len(vocabulary.words) > 1500 and vocabulary.size > 1500 + len(vocabulary.class_total) > 1500 + lm.CLASSES
    assert lm.outputs_of(100 * 40_000) == 10 * lm.outputs_of(40_000) > lm.OUTPUTS
    assert abs(vocabulary.unigram.sum() - 1) < 1e-9 and vocabulary.distinct == 40_001


def test_words_of_any_rank_are_normalised_and_learned():
    n = 5000
    v = lm.Vocabulary({}, np.full(n, 1 / n), np.full(400, 3.0), 10, 4)
    model, symbols = lm.Model.fresh(v), np.tile([4700, 4100, 4900, 1200, 3300, 2500], 3000)
    logs = model.log_probabilities(np.arange(n), np.full(n, 4700), np.full(n, 4100))
    assert abs(np.exp(logs).sum() - 1) < 1e-5
    for turn in range(30):
        lm.Trainer(model, v.unigram, turn).window(symbols, *lm.contexts_of(symbols, np.array([0]), n))
    logs = model.log_probabilities(symbols[2:], symbols[1:-1], symbols[:-2])
    assert logs.mean() > np.log(1 / n) + 2
    again = lm.Model.of_rows(model.rows(), n)
    assert all((a == b).all() for a, b in zip(vars(model).values(), vars(again).values()))


def test_tokens_are_those_of_python():
    import pyarrow as pa

    texts = ["  a B  a ", "", None, "\x0bx\x0c\x1c \u0085Ä\ty\r\n", "".join(map(chr, range(300))), "b"]
    words, tokens, lengths = lm._numbered(pa.array(texts))
    want = [lm.tokens_of(t) for t in texts]
    assert lengths.tolist() == [len(own) for own in want]
    assert [words[i] for i in tokens] == [w for own in want for w in own] and len(set(words)) == len(words)
    assert lm._numbered(pa.array([None, ""]))[1].tolist() == [0, 0]


def test_texts_are_split_once_and_chunks_hold_their_words(spark):
    rows = [(i, f"w{i % 7} common {'x' * (i % 3)}") for i in range(60)] + [(None, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    chunks = lm._chunked(docs)
    assert "text" not in chunks.columns  # training and scoring read numbers
    own = chunks.collect()
    assert sum(len(c.doc_id) for c in own) == len(rows) and sum(map(len, (c.length for c in own))) == len(rows)
    assert sum(len(c.tokens) for c in own) == 4 * sum(len(lm.tokens_of(t)) for _, t in rows)
    counts = Counter()
    for r in lm._chunk_words(chunks).collect():
        counts[r.h] += r.n
    want = Counter(lm.signed_hash(w) for i, t in rows if not held(i) for w in lm.tokens_of(t))
    assert {h: n for h, n in counts.items() if n} == want


def test_grouped_sums_and_noise_shares():
    rng = np.random.default_rng(3)
    rows = np.concatenate([np.zeros(500, int), rng.integers(0, 9000, 4000), rng.integers(0, 40, 900)])
    for n in (9000, 100_000):
        values = rng.normal(size=(len(rows), 5)).astype(np.float32)
        found, sums = lm._sums_by_row(rows, values, n)
        want = np.zeros((n, 5))
        np.add.at(want, rows, values)
        assert sorted(found.tolist()) == np.unique(rows).tolist() and np.allclose(sums, want[found], atol=1e-4)
    y = np.linspace(-12, 12, 1001, dtype=np.float32)[:, None]
    assert np.allclose(lm._noise_share(y / 64, np.float32(2)), 2 / (1 + np.exp(y.astype(float))), rtol=1e-3, atol=1e-6)
    far = lm._noise_share(np.array([[-500.0, 500.0]], np.float32), np.float32(1))
    assert far[0, 0] == 1 and 0 <= far[0, 1] < 1e-12


def test_normalisers_of_pairs(monkeypatch):
    rng = np.random.default_rng(4)
    first, second, outputs = (rng.normal(0, 2, (k, lm.DIM)).astype(np.float32) for k in (30, 20, 50))
    bias = rng.normal(size=50).astype(np.float32)
    first[3] *= 60  # both factors of a score may be far from their own largest
    one, two = np.sort(rng.integers(0, 30, 600)), rng.integers(0, 20, 600)
    scores = (first[one] + second[two]).astype(float) @ outputs.T.astype(float) + bias
    top = scores.max(axis=1)
    want = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
    for most in (lm.FACTORS, 1000):
        monkeypatch.setattr(lm, "FACTORS", most)
        assert np.allclose(lm._pair_log_sums(first, one, second, two, outputs, bias), want, rtol=1e-5, atol=1e-4)


def test_scores_follow_from_the_model_word_by_word():
    n = 1200
    v = lm.Vocabulary({}, np.full(n, 1 / n), np.full(96, 3.0), 10, 4)
    model = lm.Model.fresh(v)
    rng = np.random.default_rng(6)
    symbols = rng.integers(0, n, 3000)
    one, two = lm.contexts_of(symbols, np.array([0, 1000, 1001]), n)
    lm.Trainer(model, v.unigram, 1).window(symbols, one, two)
    got, width = model.log_probabilities(symbols, one, two), lm.width_of(n)
    for i in (0, 1, 2, 999, 1000, 1001, 1002, 2999):
        x = (model.inputs[one[i]] * model.scales[0] + model.inputs[two[i]] * model.scales[1]).astype(float)
        blocks = model.block_outputs @ x + model.block_bias
        a = symbols[i] // width
        inner = model.outputs[a * width:(a + 1) * width] @ x + model.bias[a * width:(a + 1) * width]
        want = (blocks[a] - np.log(np.exp(blocks).sum()) + inner[symbols[i] - a * width] - np.log(np.exp(inner).sum()))
        assert abs(got[i] - want) < 1e-4


def test_counts_by_shelves_of_hashes(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * k) % 37}" for k in range(i % 9))) for i in range(80)]
    monkeypatch.setattr(lm, "CHUNK_BYTES", 300)
    monkeypatch.setattr(lm, "SHELF", 20)
    chunks = lm._chunked(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    counted = lm._counted(chunks).collect()
    want = Counter(lm.signed_hash(w) for i, t in rows if not held(i) for w in lm.tokens_of(t))
    distinct = [dict(zip(r.h, r.c)) for r in counted if r.chunk is None]
    assert len(distinct) > 4 and {h: c for d in distinct for h, c in d.items() if c} == want
    for row in chunks.collect():
        own = sorted((r for r in counted if r.chunk == row.chunk), key=lambda r: r.shelf)
        got = np.concatenate([np.frombuffer(r.counts, np.int64) for r in own])
        assert got.tolist() == [want[h] for h in sorted(row.h)]
    _same(lm.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect(), brute(rows))
