"""Token-ID files of patched frame-of-reference blocks.

Layout of one file (little-endian): the blocks, one after another; the block index; the
document index; a 48-byte footer.

* block: u32 minimum, u8 width, u8 unused, u16 values, u32 exceptions; the values less the
  minimum, packed ``width`` bits each (lowest bit first); per exception its u16 position and
  u32 value less the minimum. The width covers ``PERCENTILE`` of the block's values; the others
  are exceptions, whose packed bits are zero.
* block index: u64 byte offset per block. All blocks but the last hold ``BLOCK`` ids, so any
  id range is read from the blocks it touches.
* document index: u64 first id of every document, in file order, then the end.
* footer: magic, u32 block size, u64 ids, blocks, documents, u64 place of the block index,
  u32 crc32 of both indexes.

Documents are range-partitioned and sorted by id, and each partition writes one file with
a name of its own per attempt; the manifest table, committed by Spark, names the files of the attempts that
succeeded. So a lost executor leaves at most an unreferenced file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored
from adlens.operators.dimensions import join_dimension
from adlens.session import scratch_path

BLOCK = 4096
PERCENTILE = 0.9
END_ID = 1
MAGIC = b"PFORIDS1"
_HEAD = struct.Struct("<IBBHI")
_FOOT = struct.Struct("<8sIQQQQI")
# A worker's cache of encoded words is emptied at this many entries (about 100 bytes each), or at this many bytes
# of words and ids: where texts have no spaces a "word" is a sentence.
CACHE_WORDS = 1_500_000
CACHE_BYTES = 96 << 20
# A task goes on with a new file at this many ids or documents.
FILE_IDS = 1 << 26
FILE_DOCS = 1 << 18
_MARKS = b".,;:!?*$%&#|"
_TOKENIZERS: dict = {}


# --- blocks -----------------------------------------------------------------------------
def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65535 unsigned 32-bit ids."""
    low = int(ids.min())
    rest = ids.astype(np.uint32) - np.uint32(low)
    bound = int(np.partition(rest, at := min(len(rest) - 1, int(percentile * len(rest))))[at])
    width = bound.bit_length()
    odd = np.flatnonzero(rest >> np.uint32(width)) if width < 32 else np.empty(0, np.int64)
    kept = rest.copy()
    kept[odd] = 0
    bits = np.unpackbits(kept.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    body = np.packbits(bits, axis=None, bitorder="little").tobytes()
    return (_HEAD.pack(low, width, 0, len(ids), len(odd)) + body
            + odd.astype("<u2").tobytes() + rest[odd].astype("<u4").tobytes())


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, width, _, n, odd = _HEAD.unpack_from(data, at)
    at += _HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), bitorder="little")[:n * width].reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    rest = np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(n).copy()
    if odd:
        where = np.frombuffer(data, "<u2", odd, at + size)
        rest[where] = np.frombuffer(data, "<u4", odd, at + size + 2 * odd)
    return rest + np.uint32(low)


# --- files ------------------------------------------------------------------------------
def _uri(path: str) -> str:
    """A path as Spark names it, as pyarrow names it: local files without a scheme, s3a as s3."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return re.sub("^s3[an]://", "s3://", path)


def _fs(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    path = _uri(path)
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


class Writer:
    """Appends documents to one file; memory holds one block and the indexes' integers."""

    def __init__(self, path: str):
        self.name = path
        self.fs, self.path = _fs(path)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.path)
        self.blocks, self.docs, self.rest, self.ids, self.bytes = [], [], np.empty(0, np.uint32), 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.docs.append(self.ids)
        self.ids += len(ids)
        self.rest = np.concatenate([self.rest, ids]) if len(self.rest) else ids
        while len(self.rest) >= BLOCK:
            self._block(self.rest[:BLOCK])
            self.rest = self.rest[BLOCK:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack_block(ids)
        self.blocks.append(self.bytes)
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        index = np.array(self.blocks, "<u8").tobytes() + np.array([*self.docs, self.ids], "<u8").tobytes()
        self.out.write(index)
        self.out.write(_FOOT.pack(MAGIC, BLOCK, self.ids, len(self.blocks), len(self.docs), self.bytes,
                                  zlib.crc32(index)))
        self.out.close()


class Reader:
    """Random access to one file: ``ids(a, b)`` reads only the blocks of that range."""

    def __init__(self, path: str):
        system, path = _fs(path)
        self.file = system.open_input_file(path)
        size = self.file.size()
        magic, self.block, self.n, blocks, docs, place, crc = _FOOT.unpack(
            self.file.read_at(_FOOT.size, size - _FOOT.size))
        index = self.file.read_at(size - _FOOT.size - place, place)
        if magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError(f"not a token file, or damaged: {path}")
        self.starts = np.frombuffer(index, "<u8", blocks).astype(np.int64).tolist() + [place]
        self.docs = np.frombuffer(index, "<u8", docs + 1, 8 * blocks).astype(np.int64)
        self._last = (-1, np.empty(0, np.uint32))

    def _block(self, k: int) -> np.ndarray:
        if self._last[0] != k:
            self._last = (k, unpack_block(self.file.read_at(self.starts[k + 1] - self.starts[k], self.starts[k])))
        return self._last[1]

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        parts = [self._block(k) for k in range(first, last + 1)]
        return np.concatenate(parts)[a - first * self.block:b - first * self.block]

    def close(self) -> None:
        self.file.close()


# --- tokenizer --------------------------------------------------------------------------
class WordEncoder:
    """Whole texts by way of their white-space separated words.

    This tokenizer replaces white space by spaces, lower-cases character by character and drops the
    spaces between pre-tokens; composition never crosses a space either. So the ids of a
    text are the ids of its words (split at ASCII white space), one after another, and each
    distinct word needs the library once per worker while it is cached.

    Added tokens such as <|endoftext|> the library finds in the text as it stands, before all that,
    and their neighbours are encoded apart. So texts are cut at them first; what lower-casing makes look like
    one is plain text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # for words, which hold no added token any more
        # With a space before it an added token is no word.
        ids = {got.content: k for k, got in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {b" " + text.encode(): array("I", [k]).tobytes() for text, k in ids.items()}
        longest = sorted(ids, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest)) or '(?!)'})")
        self.known: dict[bytes, bytes] = dict(self.added)
        self.held = 0  # bytes of the words and ids in ``known``

    def _learn(self, words: set[bytes]) -> None:
        """Adds words to the cache. Marks that end a word after an ASCII letter or digit are a
        pre-token of their own, so word and marks are looked up apart."""
        known, new, cut = self.known, set(), []
        for word in words:
            core = word.rstrip(_MARKS)
            if core == word or not core[-1:].isalnum():
                new.add(word)
                continue
            marks = word[len(core):]
            cut.append((word, core, marks))
            if core not in known:
                new.add(core)
            if marks not in known:
                new.add(marks)
        listed = list(new)
        for at in range(0, len(listed), 4096):
            part = listed[at:at + 4096]
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            learned = [array("I", got.ids).tobytes() for got in encoded]
            known.update(zip(part, learned))
            self.held += sum(map(len, part)) + sum(map(len, learned))
        joined = [known[core] + known[marks] for _, core, marks in cut]
        known.update(zip((word for word, _, _ in cut), joined))
        self.held += sum(len(word) for word, _, _ in cut) + sum(map(len, joined))

    def _words(self, text: str) -> list[bytes]:
        if not self.cut.search(text):
            return text.encode().lower().split()
        out = []
        for place, part in enumerate(self.cut.split(text)):
            out += [b" " + part.encode()] if place % 2 else part.encode().lower().split()
        return out

    def batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self._words(t or "") for t in texts]
        if len(self.known) > CACHE_WORDS or self.held > CACHE_BYTES:
            self.known.clear()
            self.known.update(self.added)
            self.held = 0
        self._learn(set().union(*split).difference(self.known))
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, own)), np.uint32) for own in split]


def word_encoder(path: str) -> WordEncoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordEncoder(path)
    return _TOKENIZERS[path]


# --- operators --------------------------------------------------------------------------
def write_files(docs: DataFrame, tokenizer: str, folder: str, partitions: int, end_id: int = END_ID,
                id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS,
                file_docs: int = FILE_DOCS) -> DataFrame:
    """Writes the token files and returns the manifest: ``path, part, seq, n_docs, n_ids, doc_ids`` per file.

    Null and empty texts are just the end id; a text of any length is encoded whole and lies in one file.
    Ids ascend, nulls first; rows with one id are ordered by a hash of their text, so any number of them can
    be spread over files; rows alike in both are written as often as they occur. A task closes a file at ``file_ids``
    ids or ``file_docs`` documents (looked at every 256 rows) and goes on with the next ``seq``, so neither a
    file nor its manifest row grows with the table. An empty table writes no files; extra columns are ignored.
    """
    base = pick(docs, doc_id=id_col, text=text_col).withColumn("tie", F.xxhash64("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    ordered = base.repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        def closed() -> pa.RecordBatch:
            writer.close()
            ids = pa.concat_arrays(keys)
            return pa.RecordBatch.from_pydict({
                "path": [writer.name], "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "seq": pa.array([seq], pa.int32()), "n_docs": [len(ids)], "n_ids": [writer.ids],
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)})

        writer, keys, seq = None, [], 0
        encoder = word_encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                writer = writer or Writer(f"{folder}/{uuid.uuid4().hex}.pfor")
                for ids in encoder.batch(part.column(1).to_pylist()):
                    writer.add(np.concatenate([ids, end]))
                keys.append(part.column(0))
                if writer.ids >= file_ids or len(writer.docs) >= file_docs:
                    yield closed()
                    writer, keys, seq = None, [], seq + 1
        if writer:
            yield closed()

    return stored(ordered.mapInArrow(
        run, f"path string, part int, seq int, n_docs long, n_ids long, doc_ids array<{id_type}>"), "token-manifest")


def read_files(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, read back from the files."""
    id_type = manifest.schema["doc_ids"].dataType.elementType.simpleString()
    # Prefix sums in two levels: one row per task in the window without partitions, files within their task.
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(
        W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("seq").rowsBetween(
        W.unboundedPreceding, -1)), F.lit(0))
    starts = stored(manifest.select("path", "part", inside.alias("inside")).join(parts, "part").select(
        F.col("path").alias("__path"), (F.col("base") + F.col("inside")).alias("start0")), "token-starts")
    files = join_dimension(manifest.select("path", "doc_ids"), starts, F.col("path") == F.col("__path"), "inner").drop("__path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                reader = Reader(batch.column("path")[row].as_py())
                start0, keys = batch.column("start0")[row].as_py(), batch.column("doc_ids")[row].values
                edges = reader.docs
                for at in range(0, len(edges) - 1, 4096):
                    own = edges[at:at + 4097]
                    crcs = [zlib.crc32(reader.ids(a, b).astype("<u4").tobytes()) for a, b in zip(own, own[1:])]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": keys.slice(at, len(own) - 1), "start": pa.array(start0 + own[:-1], pa.int64()),
                        "n_tokens": pa.array(np.diff(own), pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())})
                reader.close()

    return files.repartition(max(1, manifest.count())).mapInArrow(
        run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def op6(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_files(write_files(docs, tokenizer, scratch_path(spark, "token-files"), parts))
