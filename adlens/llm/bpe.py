"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

Texts are encoded inside Arrow batches, one text at a time. A long text is first cut at
places where the pre-token pattern always has a border, whatever stands around, so every
piece is encoded alone and the ids are joined: a letter, digit or mark followed by a space
or line end (no pattern branch holds white space after another character, and all look-ahead
concerns white space runs, which start at the cut), and a letter followed by punctuation (letter
runs hold letters alone). Decoding works on raw bytes, so a token that ends inside a
character is no special case.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import pick

PIECE_CHARS = 1 << 15
_BORDER = re.compile("(?<=[!-~])[ \n]|(?<=[A-Za-z一-龥])[,.;:、。，！？]")
_ENCODERS: dict = {}


def encoder(ranks: str, pattern: str):
    """The tiktoken encoder of a rank file, built once per Python worker."""
    if (ranks, pattern) not in _ENCODERS:
        import tiktoken

        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))}
        _ENCODERS[ranks, pattern] = tiktoken.Encoding(
            "local", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODERS[ranks, pattern]


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` cut at safe borders into pieces of about ``size`` characters; a stretch
    without any border stays in one piece."""
    at = 0
    while len(text) - at > size:
        border = _BORDER.search(text, at + size)
        if border is None:
            break
        yield text[at:border.start()]
        at = border.start()
    yield text[at:]


def encode_text(text: str | None, enc) -> list[int]:
    ids: list[int] = []
    for piece in pieces(text or ""):
        ids += enc.encode_ordinary(piece)
    return ids


def _rows(batch: pa.RecordBatch, step: int = 256) -> Iterator[tuple[pa.Array, list]]:
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield part.column(0), part.column(1).to_pylist()


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           ids: bool = True, digests: bool = False) -> DataFrame:
    """``doc_id, n_tokens`` per row, with the token ``ids`` and/or SHA-256 digests of the
    decimal ids (joined by commas) and of the decoded bytes.

    A null or empty text has no tokens. Rows are independent, so repeated rows, ties, null
    ids, empty tables and extra columns need no care. Nothing is shuffled.
    """
    base = pick(docs, doc_id=id_col, text=text_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long" + ", ids array<int>" * ids \
        + ", ids_sha256 string, decoded_sha256 string" * digests

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern)
        for batch in batches:
            for keys, texts in _rows(batch):
                counts, lists, sha_ids, sha_raw = [], [], [], []
                for text in texts:
                    n, kept, of_ids, of_raw = 0, [], hashlib.sha256(), hashlib.sha256()
                    for piece in pieces(text or ""):
                        got = enc.encode_ordinary(piece)
                        if digests and got:
                            of_ids.update((("," if n else "") + ",".join(map(str, got))).encode())
                            of_raw.update(enc.decode_bytes(got))
                        if ids:
                            kept += got
                        n += len(got)
                    counts.append(n)
                    lists.append(kept)
                    sha_ids.append(of_ids.hexdigest())
                    sha_raw.append(of_raw.hexdigest())
                columns = {"doc_id": keys, "n_tokens": pa.array(counts, pa.int64())}
                if ids:
                    columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                if digests:
                    columns |= {"ids_sha256": pa.array(sha_ids, pa.string()),
                                "decoded_sha256": pa.array(sha_raw, pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

    return base.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, raw`` (the exact bytes) and ``text`` (null where the bytes are not UTF-8).
    Null ids decode to no bytes."""
    base = pick(encoded, doc_id=id_col, ids=ids_col)
    id_type = base.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern)
        for batch in batches:
            for keys, lists in _rows(batch):
                raw = [enc.decode_bytes(x or []) for x in lists]
                yield pa.RecordBatch.from_pydict({"doc_id": keys, "raw": pa.array(raw, pa.binary())})

    out = base.mapInArrow(run, f"doc_id {id_type}, raw binary")
    return out.withColumn("text", F.try_validate_utf8(F.col("raw").cast("string")))


def op4(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    return encode(docs, ranks, pattern, ids=False, digests=True)
