"""Edit-aware counts equal counting the edited text from scratch."""

import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import SF, odd_rows

from adlens.llm import bpe
from adlens.llm import token_counts as T
from adlens.llm.common import read_table

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
ENC = bpe.encoder(RANKS, P.PATTERN)
ALPHABET = " \n\tabzAZ09'.,;!?é日本。 s't"


def count(part):
    return len(ENC.encode_ordinary(part))


def spliced(text, edits):
    for start, stop, new in edits:
        start = min(max(start, 0), len(text))
        stop = min(max(stop, start), len(text))
        text = text[:start] + new + text[stop:]
    return text


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=200),
       st.lists(st.tuples(st.integers(-2, 210), st.integers(-2, 210), st.text(alphabet=ALPHABET, max_size=40)), max_size=8))
def test_any_edits(text, edits):
    tree = T.TokenTree(text, count, 8)
    for n, (start, stop, new) in enumerate(edits, 1):
        tree.edit(start, stop, new)
        want = spliced(text, edits[:n])
        assert tree.text == want and tree.chars[1] == len(want) and tree.n_tokens == count(want)


def test_an_edit_of_a_long_text_reads_little_again():
    text = "some words in a long text. " * 20_000
    tree = T.TokenTree(text, count)
    before = tree.encoded
    tree.edit(200_000, 200_010, "other")
    assert tree.n_tokens == count(spliced(text, [(200_000, 200_010, "other")]))
    assert tree.encoded - before < 5 * T.SEGMENT_CHARS


def _edits(text):
    n = len(text)
    tail, middle = text[n - n // 10:][:min(200, n // 10)] if n // 10 else "", text[n // 2:n // 2 + 20].upper()
    return [(0, 0, tail), (n // 4, n // 4 + 40, ""), (n // 2, n // 2 + 20, middle * 2)]


def _want(rows):
    return sorted(str((i, count(t or ""), 3, count(e := spliced(t or "", _edits(t or ""))), len(e))) for i, t in rows)


def _got(frame):
    return sorted(str((r.doc_id, r.n_tokens, r.n_edits, r.n_tokens_after, r.n_chars_after)) for r in frame.collect())


def test_documents_odd_rows_and_empty_table(spark, odd, empty):
    docs = read_table(spark, SF, "documents")
    assert _got(T.op7(docs, RANKS, P.PATTERN)) == _want([(r.doc_id, r.text) for r in docs.collect()])
    assert _got(T.op7(odd, RANKS, P.PATTERN)) == _want([(r[0], r[1]) for r in odd_rows()])
    assert T.op7(empty, RANKS, P.PATTERN).count() == 0


def test_null_edits(spark):
    rows = spark.createDataFrame(
        [(1, "some text", None), (2, None, [(0, 0, "new")]), (3, "abc", [(None, None, None), None])],
        "doc_id long, text string, edits array<struct<start int, stop int, new string>>")
    got = {r.doc_id: r.n_tokens_after for r in T.edited_counts(rows, RANKS, P.PATTERN, "edits").collect()}
    assert got == {1: count("some text"), 2: count("new"), 3: count("abc")}
