"""Periodic run detection by recompression.

The words of a text are symbols. Recompression shortens the sequence in turns: block
compression replaces every maximal block of one symbol by one symbol that stands for (symbol,
length), pair compression cuts the alphabet in two halves and replaces every neighbouring (left,
right) by one symbol. Equal pieces become equal symbols wherever they stand, so the levels are a
run-length grammar of the text and answer "how far do positions i and j agree" (LCE) in a few
steps a level: climb while the symbols agree, and from the first that differ go down again.

A run of period q and at least ``4 q`` words holds a point of the grid with step ``3 q``, from
which both extensions are asked; grids over all periods have harmonic size, n log n points in
all. Texts are put end to end with a symbol of its own after each, so one grammar serves many short
texts, and all questions of a batch climb together in numpy. No suffix arrays, and no shuffle:
rows are independent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import pick

LEAST_WORDS = 6
LEAST_PERIODS = 4
# Words that share one grammar (a longer text has one of its own), and grid points looked at together.
BATCH_WORDS = 1 << 16
GRID_POINTS = 1 << 20

RUN = "struct<start:long,length:long,period:long>"


class Grammar:
    """Levels of a sequence. ``symbols[l]``; ``first[l]``: where in level l each symbol of level
    l + 1 begins, and the end; ``up[l]``: the symbol of level l + 1 that holds a position;
    ``block[l]``: whether level l + 1 came from blocks rather than pairs."""

    def __init__(self, s: np.ndarray):
        self.symbols, self.first, self.up, self.block = [s], [], [], []
        salt = 0
        while len(s) > 1:
            first = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1, [len(s)]])
            if len(first) <= len(s):
                sizes = np.diff(first)
                s = self._add(first, s[first[:-1]] * (int(sizes.max()) + 1) + sizes, True)
            right = None
            while len(s) > 1 and (right is None or len(right) == 0):
                # A bit of a mixed symbol number deals the alphabet in two halves.
                salt += 1
                side = ((s + salt).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(61) & np.uint64(1)).astype(bool)
                lr, rl = np.flatnonzero(~side[:-1] & side[1:]), np.flatnonzero(side[:-1] & ~side[1:])
                right = (lr if len(lr) >= len(rl) else rl) + 1
            if len(s) > 1:
                begins = np.ones(len(s), bool)
                begins[right] = False
                first = np.append(np.flatnonzero(begins), len(s))
                second = np.zeros(len(s) + 1, np.int64)
                second[right - 1] = s[right] + 1
                s = self._add(first, s[first[:-1]] * (int(s.max()) + 2) + second[first[:-1]], False)

    def _add(self, first: np.ndarray, keys: np.ndarray, block: bool) -> np.ndarray:
        names = np.unique(keys, return_inverse=True)[1]
        self.first.append(first)
        self.up.append(np.repeat(np.arange(len(names)), np.diff(first)))
        self.block.append(block)
        self.symbols.append(names)
        return names

    def mirrored(self) -> Grammar:
        """The same grammar read from the end."""
        m = object.__new__(Grammar)
        m.symbols = [s[::-1] for s in self.symbols]
        m.first = [f[-1] - f[::-1] for f in self.first]
        m.up = [u[-1] - u[::-1] for u in self.up]
        m.block = self.block
        return m

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from ``i`` and from ``j`` on (``i != j``) agree, for each pair. Some
        later symbol must occur once only, else an extension would leave the sequence."""
        begin, i, j = i, i.copy(), j.copy()
        stop = np.zeros(len(i), np.int64)
        live = np.arange(len(i))
        for level, s in enumerate(self.symbols):
            live = live[s[i[live]] == s[j[live]]]
            if not len(live):
                break
            x, y = i[live], j[live]
            first, up = self.first[level], self.up[level]
            ux, uy = up[x], up[y]
            inside = (first[ux] != x) | (first[uy] != y)
            step = np.minimum(first[ux + 1] - x, first[uy + 1] - y) if self.block[level] else 1
            x, y = x + inside * step, y + inside * step
            same = s[x] == s[y]
            i[live], j[live] = np.where(same, up[x], x), np.where(same, up[y], y)
            stop[live] += same
            live = live[same]
        for level in range(int(stop.max(initial=0)) - 1, -1, -1):
            live = np.flatnonzero(stop > level)
            s, first = self.symbols[level], self.first[level]
            a, b = i[live], j[live]
            x, y = first[a], first[b]
            step = np.minimum(first[a + 1] - x, first[b + 1] - y) if self.block[level] else 1
            same = s[x] == s[y]
            i[live], j[live] = x + same * step, y + same * step
        return i - begin


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Text number, position and period of every grid point, in bounded blocks."""
    most = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    text = np.repeat(np.arange(len(sizes)), most)
    period = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period
    points = -(-(sizes[text] - period) // step)
    ends = np.cumsum(points)
    at = 0
    while at < len(text):
        base = ends[at] - points[at]
        to = max(at + 1, int(np.searchsorted(ends, base + GRID_POINTS, "right")))
        owner = np.repeat(np.arange(at, to), points[at:to])
        nth = np.arange(len(owner)) - np.repeat(ends[at:to] - points[at:to] - base, points[at:to])
        yield text[owner], starts[text[owner]] + nth * step[owner], period[owner]
        at = to


def find_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """``(start, length, period)`` of every run of every sequence of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(texts) or sizes.max() < LEAST_WORDS:
        return out
    numbers: dict = {}
    get = numbers.setdefault
    # One symbol in front, and one of its own after each text.
    starts = np.cumsum(sizes + 1) - sizes
    s = np.empty(int(starts[-1] + sizes[-1]) + 1, np.int64)
    for t, at in zip(texts, starts):
        s[at:at + len(t)] = [get(w, len(numbers)) for w in t]
    s[np.append(0, starts + sizes)] = len(numbers) + np.arange(len(texts) + 1)
    last = len(s) - 1
    grammar = mirror = None
    found = []
    for text, i, q in _grid(starts, sizes):
        good = s[i] == s[i + q]
        text, i, q = text[good], i[good], q[good]
        # A run holds the point a period further or a period before, too.
        good = (s[i + q] == s[np.minimum(i + 2 * q, last)]) | (s[np.maximum(i - q, 0)] == s[i])
        text, i, q = text[good], i[good], q[good]
        if not len(i):
            continue
        if grammar is None:
            grammar = Grammar(s)
            mirror = grammar.mirrored()
        ahead, back = grammar.lce(i, i + q), mirror.lce(last - (i - 1), last - (i + q - 1))
        length = back + ahead + q
        good = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found.append(np.stack([text[good], (i - back)[good] - starts[text[good]], length[good], q[good]]))
    if not found:
        return out
    rows = np.concatenate(found, axis=1)
    # A stretch seen with several periods has the smallest; seen from several points it is one run.
    rows = rows[:, np.lexsort(rows[[3, 2, 1, 0]])]
    new = np.append(True, (rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) if rows.shape[1] else np.empty(0, bool)
    rows = rows[:, new]
    for t, start, length, period in rows[:, np.lexsort(rows[[3, 1, 0]])].T.tolist():
        out[t].append((start, length, period))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest length / period, exactly; ties: smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """``words`` without those that a run holds after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def _packs(batches: Iterator[pa.RecordBatch], step: int = 256) -> Iterator[tuple[pa.Array, list[list[bytes]]]]:
    """Ids and words of a few texts at a time, about BATCH_WORDS words or one text."""
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            begin, total, texts = 0, 0, []
            for k, text in enumerate(part.column(1).to_pylist()):
                words = (text or "").encode().split()
                if texts and total + len(words) > BATCH_WORDS:
                    yield part.column(0).slice(begin, len(texts)), texts
                    begin, total, texts = k, 0, []
                texts.append(words)
                total += len(words)
            if texts:
                yield part.column(0).slice(begin, len(texts)), texts


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  words: Callable[[object, list], list] | None = None) -> DataFrame:
    """``doc_id``, ``runs`` (start, length, period by start, then period; start is a word
    number from 0), ``best`` (the run of greatest length / period) and ``collapsed`` (the words
    that no run holds after its first period, joined by one space) per row of ``docs``.

    A run is a maximal stretch of words with smallest period q, of at least 6 words and 4 q
    words. Words are runs of characters other than space and \\x09-\\x0D, compared byte by byte;
    ``words``, if given, maps an id and its words to the words to be read instead. A
    null, empty or all-space text has no runs, a null ``best`` and an empty ``collapsed``.
    Texts of any length are read whole. Rows are independent: repeated rows, null ids, ties and
    empty tables need no care; extra columns are ignored.
    """
    base = pick(docs, doc_id=id_col, text=text_col)
    kind = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])
    named = lambda r: dict(zip(("start", "length", "period"), r))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in _packs(batches):
            if words:
                texts = [words(k, w) for k, w in zip(keys.to_pylist(), texts)]
            found = find_runs(texts)
            best = [strongest(r) for r in found]
            yield pa.RecordBatch.from_pydict({
                "doc_id": keys, "runs": pa.array([[named(x) for x in r] for r in found], pa.list_(kind)),
                "best": pa.array([b and named(b) for b in best], kind),
                "collapsed": pa.array([b" ".join(collapse(w, r)).decode() for w, r in zip(texts, found)], pa.string())})

    id_type = base.schema["doc_id"].dataType.simpleString()
    return base.mapInArrow(run, f"doc_id {id_type}, runs array<{RUN}>, best {RUN}, collapsed string")


def planted(doc_id: int | None, words: list) -> list:
    """One text in ten gets a periodic tail: with h the CRC-32 of the decimal id, a word i from
    ``a = (h div 10) % n`` on becomes word ``a + (i - a) % p``, ``p = 1 + (n - a) div (3 + (h div 10) % 8)``.
    Others, and those of null ids, stay."""
    h, n = 1 if doc_id is None else crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def op11(docs: DataFrame) -> DataFrame:
    """Runs of ``documents`` with planted tails, as digests."""
    found = periodic_runs(docs, words=planted)
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"),
                                                  F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
