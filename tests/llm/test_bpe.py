"""Byte-level BPE: cuts are invisible, and texts come back byte for byte."""

import hashlib

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, odd_rows

from adlens.llm import bpe
from adlens.llm.common import read_table

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ENC = bpe.encoder(RANKS, P.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\rabzAZ09'.,;!?é日本。、́  \x1c<|>", max_size=120))
def test_pieces_encode_like_the_whole(text):
    cut = list(bpe.pieces(text, 3))
    assert "".join(cut) == text
    assert [i for p in cut for i in ENC.encode_ordinary(p)] == ENC.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, " " * 200_000, "\n" * 100_000, "word " * 50_000, "日本語" * 30_000])
def test_very_long_texts(text):
    ids = bpe.encode_text(text, ENC)
    assert ENC.decode_bytes(ids) == text.encode()


def _want(text):
    ids = ENC.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(
        (text or "").encode()).hexdigest()


def test_odd_rows_and_empty_table(spark, odd, empty):
    got = bpe.op4(odd, RANKS, P.PATTERN).collect()
    assert sorted(map(str, ((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got))) == sorted(
        map(str, ((r[0], *_want(r[1])) for r in odd_rows())))
    assert bpe.op4(empty, RANKS, P.PATTERN).count() == 0


def test_round_trip_through_tables(spark):
    docs = read_table(spark, SF, "documents")
    back = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    joined = docs.join(back.withColumnRenamed("text", "again"), "doc_id")
    assert joined.filter("coalesce(text, '') <=> again").count() == docs.count()
    half = spark.createDataFrame([(1, ENC.encode_ordinary("日本")[:1]), (2, None)], "doc_id long, ids array<int>")
    assert {r.doc_id: r.raw for r in bpe.decode(half, RANKS, P.PATTERN).collect()}[2] == b""
