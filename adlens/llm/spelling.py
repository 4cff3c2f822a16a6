"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if one inserted, deleted or replaced code point makes one of the other. The
vocabulary goes into blocked Bloom filters, sharded by word length and sent to all tasks. Each
word's deletions and replacements (an insertion is the other word's deletion) are probed against
the shards of their length without being built: the hash is a polynomial over the code points, so
an edit's hash is a sum of two running sums. Only probes that a filter may hold become strings; they
meet the vocabulary in an exact join, which removes the false ones.

Filters take 2 bytes a word. What is sent out at once is bounded (``PASS_BLOCKS``): a larger
vocabulary is probed in several passes, each with the next blocks of the filters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored

# Code points that words are made of: a-z and U+00C0 to U+00FF.
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)
RUN = re.compile("[a-zÀ-ÿ]+")
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_FACTOR = 5
DELETED = 199

# A block is 8 lanes of 64 bits, one bit of each lane a word; words of LONG code points and more share a shard.
LANES = 8
WORDS_A_BLOCK = 32
LONG = 64
# Blocks sent out at once: 32 MB.
PASS_BLOCKS = 1 << 19
_COUNTED = 200_000
_PROBES = 1 << 22
_BASE = np.uint64(0x9E3779B97F4A7C15)


def variants(text: str | None, doc_id: int | None) -> Counter:
    """Lower-cased runs of a text and their counts; where 199 divides the CRC-32 of
    ``<doc_id>:<run>`` the run has lost the code point at CRC modulo length."""
    out: Counter = Counter()
    head = None if doc_id is None else crc32(f"{doc_id}:".encode())
    for word, n in Counter(RUN.findall((text or "").encode().lower().decode())).items():
        if head is not None:
            h = crc32(word.encode(), head)
            if h % DELETED == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
        out[word] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: runs of at least 6 code points that occur at least 5 times in all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"word": pa.array(list(total), pa.string()),
                                               "n": pa.array(list(total.values()), pa.int64())})
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for word, n in variants(text, key).items():
                        if len(word) >= LEAST_LENGTH:
                            total[word] += n
                    if len(total) >= _COUNTED:
                        yield rows()
                        total.clear()
        if total:
            yield rows()

    found = pick(docs, doc_id=id_col, text=text_col).mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(length: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(length, _BASE, np.uint64), dtype=np.uint64)])


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points, one row a word; all words have ``length``."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64).reshape(-1, length)


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    sizes = np.array([len(w) for w in words])
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        step = max(1, _PROBES // (length * len(ALPHABET)))
        for k in range(0, len(at), step):
            some = at[k:k + step]
            yield length, some, [words[i] for i in some]


class Layout:
    """Where the blocks of each length shard begin; a few numbers a shard, at most LONG shards."""

    def __init__(self, counts: dict[int, int]):
        self.blocks = {s: -(-n // WORDS_A_BLOCK) for s, n in sorted(counts.items())}
        ends = np.cumsum([0, *self.blocks.values()]).tolist()
        self.start, self.total = dict(zip(self.blocks, ends)), ends[-1]

    def block(self, h: np.ndarray, length: int) -> np.ndarray | None:
        """Block of each mixed hash of words of a length; None if no word is that long."""
        shard = min(length, LONG)
        if shard not in self.blocks:
            return None
        return self.start[shard] + ((h >> np.uint64(32)) * np.uint64(self.blocks[shard]) >> np.uint64(32)).astype(np.int64)


def _bits(h: np.ndarray) -> np.ndarray:
    """A bit number for each lane: 6 bits each of a second mix of the hash."""
    g = _mixed(h ^ _BASE)
    return (g[..., None] >> (np.arange(LANES, dtype=np.uint64) * np.uint64(6))) & np.uint64(63)


def filters(words: DataFrame, layout: Layout) -> DataFrame:
    """``block, l0 .. l7``: the blocked Bloom filters of ``words`` (``word``)."""
    names = [f"l{i}" for i in range(LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, some in _by_length(batch.column(0).to_pylist()):
                h = _mixed((_points(some, length) * _powers(length)[:length]).sum(axis=1, dtype=np.uint64))
                lanes = (np.uint64(1) << _bits(h)).view(np.int64)
                yield pa.RecordBatch.from_pydict({"block": layout.block(h, length),
                                                  **{c: np.ascontiguousarray(lanes[:, i]) for i, c in enumerate(names)}})

    marks = words.select("word").mapInArrow(run, "block long, " + ", ".join(f"{c} long" for c in names))
    return marks.groupBy("block").agg(*[F.bit_or(c).alias(c) for c in names])


def _edits(some: list[str], length: int, probes: int = _PROBES) -> Iterator[tuple[int, int, np.ndarray, str]]:
    """Length, first place, hashes and kind of edits of words of one length: a row for each word, then
    (places,) for deletions and (places, letters) for replacements, in blocks of about ``probes``."""
    c, up = _points(some, length), _powers(length)
    terms = c * up[:length]
    total = terms.sum(axis=1, dtype=np.uint64)[:, None]
    # A deletion moves what follows down by one power.
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    lower = c[:, 1:] * up[:length - 1]
    after = np.zeros_like(c)
    after[:, :-1] = np.cumsum(lower[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
    yield length - 1, 0, before + after, "deleted"
    step = max(1, probes // (len(some) * len(ALPHABET)))
    for k in range(0, length, step):
        yield length, k, (total - terms[:, k:k + step])[:, :, None] + ALPHABET * up[k:min(k + step, length), None], "replaced"


def probe(words: DataFrame, layout: Layout, table, lo: int, hi: int) -> DataFrame:
    """``candidate, word, deleted``: the edits that the blocks ``lo`` to ``hi`` may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = table.value
        for batch in batches:
            for length, _, some in _by_length(batch.column(0).to_pylist()):
                for size, place, raw, kind in _edits(some, length):
                    h = _mixed(raw)
                    block = layout.block(h, size)
                    if block is None:
                        continue
                    at = np.nonzero((block >= lo) & (block < hi))
                    h, block = h[at], block[at] - lo
                    for lane in range(LANES):
                        bit = (_mixed(h ^ _BASE) >> np.uint64(6 * lane)) & np.uint64(63)
                        good = (lanes[block, lane].view(np.uint64) >> bit & np.uint64(1)).astype(bool)
                        h, block, at = h[good], block[good], tuple(x[good] for x in at)
                    out: dict[tuple[str, str], None] = {}
                    for w, k, *letter in zip(*(x.tolist() for x in at)):
                        word, k = some[w], place + k
                        edit = word[:k] + (chr(int(ALPHABET[letter[0]])) if letter else "") + word[k + 1:]
                        if edit != word:
                            out[edit, word] = None
                    if out:
                        edits, of = zip(*out)
                        yield pa.RecordBatch.from_pydict({"candidate": pa.array(edits, pa.string()), "word": pa.array(of, pa.string()),
                                                          "deleted": pa.array([kind == "deleted"] * len(of))})

    return words.select("word").mapInArrow(run, "candidate string, word string, deleted boolean")


def near_words(words: DataFrame, pass_blocks: int = PASS_BLOCKS) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of near words of ``words`` (stored ``word, n``, distinct words)."""
    spark = words.sparkSession
    sizes = words.groupBy(F.least(F.char_length("word"), F.lit(LONG)).alias("shard")).count().collect()
    layout = Layout({r["shard"]: r["count"] for r in sizes})
    blooms = stored(filters(words, layout), "spelling-filters")
    hits = None
    for lo in range(0, max(1, layout.total), pass_blocks):
        hi = min(lo + pass_blocks, layout.total)
        part = blooms.filter(F.col("block").between(lo, hi - 1)).toArrow()
        lanes = np.zeros((hi - lo, LANES), np.int64)
        at = part.column("block").to_numpy() - lo
        for i in range(LANES):
            lanes[at, i] = part.column(f"l{i}").to_numpy()
        found = probe(words, layout, spark.sparkContext.broadcast(lanes), lo, hi)
        hits = found if hits is None else hits.unionByName(found)
    hits = stored(hits, "spelling-hits")
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = hits.join(words, "word").join(known, F.col("candidate") == F.col("near")).select("word", "n", "near", "near_n", "deleted")

    def row(a, n, b, m):
        return F.struct(F.col(a).alias("word"), F.col(n).alias("n"), F.col(b).alias("near"), F.col(m).alias("near_n"))
    both = F.when(F.col("deleted"), F.array(row("word", "n", "near", "near_n"), row("near", "near_n", "word", "n"))) \
        .otherwise(F.array(row("word", "n", "near", "near_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FORM_FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the vocabulary of ``docs``.

    ``form`` is the near word of largest count (ties: smallest in code-point order) if it has at
    least ``factor`` times the word's; ``root`` is the last of the forms that follow each other
    from the word. Null and empty texts have no words; texts of any length are read whole;
    repeated rows count each time; in rows of null id nothing is deleted. An empty table gives
    no rows; extra columns are ignored.
    """
    words = stored(vocabulary(docs, id_col, text_col), "spelling-words")
    best = near_words(words).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("top"))
    good = -F.col("top.m") >= factor * F.col("n")
    table = stored(words.join(best, "word", "left").select(
        "word", F.when(good, F.col("top.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(good, -F.col("top.m")).alias("form_n")), "spelling-forms")
    # Counts grow by the factor from form to form, so chains are short; each step doubles what is known.
    links = stored(table.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")), "spelling-roots")
        links = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return table.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(docs: DataFrame) -> DataFrame:
    return spelling_variants(docs)
