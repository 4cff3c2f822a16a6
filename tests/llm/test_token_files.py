"""Token files: blocks and files round trip; ids equal the tokenizer's on whole texts."""

import os
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, odd_rows

from adlens.llm import token_files as T
from adlens.llm.common import read_table

os.environ["TOKENIZERS_PARALLELISM"] = "false"
PATH = P.path("word_bpe_49k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_blocks_round_trip(values, percentile):
    ids = np.array(values, np.uint32)
    assert (T.unpack_block(T.pack_block(ids, percentile)) == ids).all()


def test_outliers_are_exceptions_and_do_not_widen_the_block():
    ids = np.full(T.BLOCK, 7, np.uint32)
    ids[::100] = 4_000_000_000
    assert len(T.pack_block(ids)) < 500 and (T.unpack_block(T.pack_block(ids)) == ids).all()


def test_file_reads_any_range_and_notices_damage(tmp_path):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 50_000, n).astype(np.uint32) for n in (1, 0, 5000, 3, T.BLOCK, 20_000, 0)]
    path = str(tmp_path / "x" / "a.pfor")
    w = T.Writer(f"file:{path}")
    for d in docs:
        w.add(d)
    w.close()
    r, whole = T.Reader(path), np.concatenate(docs)
    assert r.n == len(whole) and r.docs.tolist() == np.cumsum([0, *map(len, docs)]).tolist()
    for a, b in ((0, 0), (0, 1), (T.BLOCK - 1, T.BLOCK + 1), (4000, 25_000), (0, len(whole))):
        assert (r.ids(a, b) == whole[a:b]).all()
    data = bytearray(open(path, "rb").read())
    data[-60] ^= 1
    open(path, "wb").write(data)
    with pytest.raises(ValueError):
        T.Reader(path)


ENCODER = T.WordEncoder(PATH)


def whole_ids(texts):
    return [e.ids for e in ENCODER.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x0b\x1c\x85\xa0ABab9'.,;!#é́İß日本—<|>endoftext", max_size=60), max_size=5))
def test_words_encode_like_whole_texts(texts):
    assert [x.tolist() for x in ENCODER.batch(texts)] == whole_ids(texts)


def _want(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for (i, _), ids in zip(order, whole_ids([t for _, t in order])):
        ids = [*ids, 1]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def _got(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: r[1])


def test_odd_rows_and_empty_table(spark, odd, empty):
    rows, got = [(r[0], r[1]) for r in odd_rows()], _got(T.op6(spark, odd, PATH))
    want = _want(rows)
    assert sorted(map(str, ((a, n, c) for a, _, n, c in got))) == sorted(map(str, ((a, n, c) for a, _, n, c in want)))
    assert [x[0] for x in got] == [x[0] for x in want]
    assert got[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:]))
    assert T.op6(spark, empty, PATH).count() == 0


def test_documents(spark):
    docs = read_table(spark, SF, "documents")
    assert _got(T.op6(spark, docs, PATH)) == _want([(r.doc_id, r.text) for r in docs.collect()])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<|endoftext", "|>", "World", "x",
                                          " ", "\n", ".", "<", "̸", "İ"]), max_size=12).map("".join), max_size=5))
def test_added_tokens_are_those_of_an_untouched_tokenizer(texts):
    from tokenizers import Tokenizer

    want = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False) if texts else []
    assert [x.tolist() for x in ENCODER.batch(texts)] == [e.ids for e in want]


def test_added_tokens_outlive_the_cache(monkeypatch):
    encoder = T.WordEncoder(PATH)
    monkeypatch.setattr(T, "CACHE_WORDS", 3)
    for _ in range(2):
        got = encoder.batch(["hello <|endoftext|> World x<|startoftext|>y"])
        assert got[0].tolist() == [3306, 49407, 1002, 343, 49406, 344]


def test_a_task_goes_on_with_new_files(spark, tmp_path):
    """Files end at their bounds; starts run on over files and tasks as in one file."""
    docs = read_table(spark, SF, "documents").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(7, "again")] * 600 + [(None, None)], docs.schema))
    one = T.write_files(docs, PATH, f"file:{tmp_path}/one", 1)
    many = T.write_files(docs, PATH, f"file:{tmp_path}/many", 3, file_docs=1)
    small = T.write_files(docs, PATH, f"file:{tmp_path}/small", 2, file_ids=1)
    assert one.count() == 1 < many.count() and small.count() > 2
    for frame in (many, small):
        rows = frame.orderBy("part", "seq").collect()
        assert max(r.n_docs for r in rows) <= 256 and sum(r.n_docs for r in rows) == docs.count()
        assert all(len(r.doc_ids) == r.n_docs for r in rows) and len({r.path for r in rows}) == len(rows)
    want, *got = [sorted(map(str, T.read_files(x).collect())) for x in (one, many, small)]
    assert got == [want, want]


def test_the_cache_is_bounded_by_bytes(monkeypatch):
    encoder = T.WordEncoder(PATH)
    monkeypatch.setattr(T, "CACHE_BYTES", 1000)
    for i in range(20):
        encoder.batch(["x" * 900 + str(i), "plain words, here."])
        assert sum(len(k) + len(v) for k, v in encoder.known.items() if k not in encoder.added) == encoder.held
        assert len(encoder.known) < 12


def test_paths_of_spark_as_paths_of_arrow():
    assert T._uri("s3a://b/k") == T._uri("s3n://b/k") == "s3://b/k" and T._uri("file:///a/b") == T._uri("file:/a/b") == "/a/b"
    assert T._uri("hdfs://h/a") == "hdfs://h/a" and T._uri("/a") == "/a"
