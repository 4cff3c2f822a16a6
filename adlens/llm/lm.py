"""Log-bilinear language model, trained by noise-contrastive estimation in numpy.

Outputs. The model predicts a symbol: the end of a text, a frequent training word, or the class of
any other word (by its last two bytes); inside a class a word has its add-one share of the class's
training tokens, with one share left for words never seen. The symbols follow the training
vocabulary without a bound: ``GROWTH`` times the root of its distinct words (``OUTPUTS`` at least),
3 of 32 of them classes. Symbols are numbered by frequency and cut into blocks of about the root of
their number. A symbol's probability is that of its block times its own inside the block, both
normalised from learned vectors. The product is a normalised distribution over words.

Model. A context is the two symbols before; its vector is the sum of their embeddings, each
scaled by its position's diagonal matrix; the score of a symbol, or of a block, is the dot product with
its output vector plus its bias. Biases start at the log of the training frequency, so
training starts from the unigram model.

Texts are read once: a chunk of texts, of bounded bytes, is stored as one row that holds the numbers of
its tokens among its own distinct words, and those words' hashes and counts. Training and scoring look up
a chunk's words, not its tokens.

Training. Each task runs over all of its training texts: windows of tokens are summed up as weighted
distinct trigrams, and mini-batches are taught to tell them from noise symbols and noise blocks drawn
from the unigram distribution (shared by a batch, so both sides are matrix products; what is drawn several
times is computed once and counts as often); only the rows that a batch meets are changed. Tasks start
from the same parameters and return the changes of the rows they met. A row's changes are averaged,
weighted by its tokens in each task, in two levels of Spark groups per slab of rows, and the next round
starts from the average.

Scoring. Each chunk meets the training counts of its own distinct words, which are counted in ranges of
the 64-bit word hash, never the whole vocabulary. A chunk's distinct contexts are normalised exactly over
all blocks, and over the symbols of the blocks that follow them: as a context is the sum of two vectors,
the exponential of its score is the product of two, which are computed once per symbol and place, not per
context.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored

END = b"\n"  # no word holds a line end
# Symbols and classes of a small vocabulary, and the symbols per root of a large one.
OUTPUTS = 1024
CLASSES = 96
GROWTH = 16
DIM = 24
ROUNDS = 2
NOISE = 96
BLOCK_NOISE = 32
BATCH = 8192
WINDOW = 1 << 20
RATE = 0.08
CHUNK_BYTES = 12 << 20
# A word needs so many training tokens to be a symbol of its own.
MIN_COUNT = 8
HOT = 1024
# Words of chunks that are counted in one group, about.
SHELF = 1 << 20
SLAB = 2048
SEED = 5
# Rows of a batch whose noise scores are held at once, and numbers in the factors of normalisers.
SLICE = 512
FACTORS = 8 << 20
# Members of a group of rows that are added up one after another.
GROUP = 8
# Normalisers whose factors' product is less are computed from the whole scores.
LEAST = 1e-30


def tokens_of(text: str | None) -> list[bytes]:
    words = (text or "").encode().lower().split()
    words.append(END)
    return words


def word_hash(word: bytes) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(word)


def signed_hash(word: bytes) -> int:
    return word_hash(word) - (1 << 64) * (word_hash(word) >> 63)


def tail_of(word: bytes) -> int:
    return zlib.crc32(word[-2:])


def outputs_of(distinct: int) -> int:
    """The number of symbols for a training vocabulary of ``distinct`` words."""
    return max(OUTPUTS, GROWTH * math.isqrt(distinct))


def width_of(size: int) -> int:
    """Symbols per block; the last block may have fewer."""
    return math.isqrt(size - 1) + 1


@dataclass
class Vocabulary:
    """Symbol 0 is the end, then the classes, then the frequent words."""
    words: dict[int, int]  # hash of a frequent word -> its symbol
    unigram: np.ndarray  # probability of each symbol
    class_total: np.ndarray  # tokens + distinct words + 1 of each class
    total: int  # N
    distinct: int  # V

    @property
    def size(self) -> int:
        return len(self.unigram)


class Symbols:
    """Symbols of words by their signed hashes and tails."""

    def __init__(self, vocabulary: Vocabulary):
        hashes = np.fromiter(vocabulary.words, np.uint64, len(vocabulary.words)).view(np.int64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.numbers = np.fromiter(vocabulary.words.values(), np.int64, len(order))[order]
        self.classes, self.end = len(vocabulary.class_total), signed_hash(END)

    def of(self, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
        out = 1 + tail % self.classes
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == h, self.numbers[at], out)
        out[h == self.end] = 0
        return out


def _log_sums(vectors: np.ndarray, outputs: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The log of each vector's summed exponentiated scores, in blocks of 4096 vectors."""
    norm = np.empty(len(vectors))
    for at in range(0, len(vectors), 4096):
        scores = vectors[at:at + 4096] @ outputs.T
        scores += bias
        top = scores.max(axis=1, keepdims=True)
        scores -= top
        np.exp(scores, out=scores)
        norm[at:at + 4096] = top[:, 0] + np.log(scores.sum(axis=1), dtype=np.float64)
    return norm


def _order(codes: np.ndarray, most: int) -> np.ndarray:
    """The order of ``codes`` (below ``most``): sorted with their places, if both fit 63 bits, which is faster."""
    bits = len(codes).bit_length()
    if most.bit_length() + bits > 63:
        return np.argsort(codes)
    both = codes << bits | np.arange(len(codes))
    both.sort()
    return both & (1 << bits) - 1


def _distinct(numbers: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``numbers`` (below ``n``) in order, and the place of each number among them."""
    there = np.zeros(n, bool)
    there[numbers] = True
    found = np.flatnonzero(there)
    place = np.empty(n, np.int32)
    place[found] = np.arange(len(found))
    return found, place[numbers]


def _pair_log_sums(first: np.ndarray, one: np.ndarray, second: np.ndarray, two: np.ndarray, outputs: np.ndarray,
                   bias: np.ndarray) -> np.ndarray:
    """``_log_sums`` of the vectors ``first[one] + second[two]``: exp(x + y) is exp(x) * exp(y), so only the
    distinct rows need exponentials. Many distinct rows are met in halves of the pairs."""
    rows, a = _distinct(one, len(first))
    others, b = _distinct(two, len(second))
    if len(rows) + len(others) > len(one):
        return _log_sums(first[one] + second[two], outputs, bias)
    if (len(rows) + len(others)) * len(bias) > FACTORS:
        half = len(one) // 2
        return np.concatenate([_pair_log_sums(first, one[to], second, two[to], outputs, bias)
                               for to in (slice(half), slice(half, None))])
    left, right = first[rows] @ outputs.T, second[others] @ outputs.T + bias
    norm = np.zeros(len(one))
    for scores, at in ((left, a), (right, b)):
        top = scores.max(axis=1)
        scores -= top[:, None]
        np.exp(scores, out=scores)
        norm += top[at]
    sums = np.empty(len(one), np.float32)
    for at in range(0, len(one), SLICE):
        to = slice(at, at + SLICE)
        np.einsum("ij,ij->i", _take(left, a[to]), _take(right, b[to]), out=sums[to])
    norm += np.log(np.maximum(sums, LEAST), dtype=np.float64)
    weak = np.flatnonzero(sums < LEAST)
    if len(weak):
        norm[weak] = _log_sums(first[one[weak]] + second[two[weak]], outputs, bias)
    return norm


@dataclass
class Model:
    inputs: np.ndarray  # (size + 1) x DIM; the last row stands before a text
    scales: np.ndarray  # 2 x DIM
    outputs: np.ndarray  # size x DIM
    bias: np.ndarray  # size
    block_outputs: np.ndarray  # blocks x DIM
    block_bias: np.ndarray  # blocks

    @staticmethod
    def fresh(vocabulary: Vocabulary) -> Model:
        rng, n = np.random.default_rng(SEED), vocabulary.size
        mass = np.add.reduceat(vocabulary.unigram, np.arange(0, n, width_of(n)))
        return Model(rng.normal(0, 0.1, (n + 1, DIM)).astype(np.float32), np.ones((2, DIM), np.float32),
                     rng.normal(0, 0.1, (n, DIM)).astype(np.float32), np.log(vocabulary.unigram).astype(np.float32),
                     rng.normal(0, 0.1, (len(mass), DIM)).astype(np.float32), np.log(mass).astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in vars(self).values()])

    @staticmethod
    def of(flat: np.ndarray, size: int) -> Model:
        blocks = -(-size // width_of(size))
        shapes = [(size + 1, DIM), (2, DIM), (size, DIM), (size,), (blocks, DIM), (blocks,)]
        ends = np.cumsum([math.prod(x) for x in shapes])[:-1]
        return Model(*[x.reshape(shape).copy() for x, shape in zip(np.split(flat, ends), shapes)])

    def rows(self) -> np.ndarray:
        """All parameters as rows of 2 x DIM + 1 numbers: the symbols and the border, the scales, the blocks."""
        n = len(self.bias)
        out = np.zeros((n + 3 + len(self.block_bias), 2 * DIM + 1), np.float32)
        out[:n + 1, :DIM], out[:n, DIM:-1], out[:n, -1] = self.inputs, self.outputs, self.bias
        out[n + 1:n + 3, :DIM] = self.scales
        out[n + 3:, DIM:-1], out[n + 3:, -1] = self.block_outputs, self.block_bias
        return out

    @staticmethod
    def of_rows(rows: np.ndarray, size: int) -> Model:
        n = size
        return Model(*[x.astype(np.float32) for x in (
            rows[:n + 1, :DIM], rows[n + 1:n + 3, :DIM], rows[:n, DIM:-1], rows[:n, -1], rows[n + 3:, DIM:-1], rows[n + 3:, -1])])

    def log_probabilities(self, symbols: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Natural log of P(symbol | one before, two before), normalised over all symbols."""
        wide, width, blocks = len(self.inputs), width_of(len(self.bias)), len(self.block_bias)
        first, second = self.inputs * self.scales[0], self.inputs * self.scales[1]
        # The distinct contexts before a block, block by block.
        own = symbols // width
        codes = (own.astype(np.int64) * wide + one) * wide + two
        order = _order(codes, blocks * wide * wide)
        codes = codes[order]
        new = np.concatenate([[True], codes[1:] != codes[:-1]])[:len(codes)]
        pair = np.empty(len(codes), np.int64)
        pair[order] = np.cumsum(new) - 1
        codes = codes[new]
        before, a, b = codes // (wide * wide), codes // wide % wide, codes % wide
        norm = _pair_log_sums(first, a, second, b, self.block_outputs, self.block_bias)
        edges = np.searchsorted(before, np.arange(blocks + 1))
        for block in np.flatnonzero(edges[1:] > edges[:-1]):
            to, part = slice(edges[block], edges[block + 1]), slice(block * width, (block + 1) * width)
            norm[to] += _pair_log_sums(first, a[to], second, b[to], self.outputs[part], self.bias[part])
        out = np.empty(len(symbols))
        for at in range(0, len(symbols), 1 << 14):
            to = slice(at, at + (1 << 14))
            s, k = symbols[to], own[to]
            vectors = _take(first, one[to]) + _take(second, two[to])
            out[to] = (np.einsum("ij,ij->i", vectors, _take(self.outputs, s) + _take(self.block_outputs, k))
                       + self.bias[s] + self.block_bias[k] - norm[pair[to]])
        return out


def _take(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return table.take(rows, axis=0, mode="clip")  # rows are inside: faster than with a check


def _sums_by_row(rows: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct row numbers (below ``n``) and the sums of ``values`` by row. Large groups are reduced
    column by column; of the others, all first members are taken at once, then all second ones."""
    order = np.argsort(rows.astype(np.uint16 if n <= 1 << 16 else np.int32), kind="stable")  # 16 bits: a radix sort
    own = rows[order]
    first = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1])
    less = first - np.append(first[1:], len(own))
    by = np.argsort(less, kind="stable")
    first, less = first[by], less[by]
    # How many groups have more than so many members.
    more = np.searchsorted(less, -np.arange(GROUP + 1), side="left")
    large = more[GROUP]
    out = _take(values, order[first])
    for k in range(1, GROUP):
        if more[k] > large:
            out[large:more[k]] += _take(values, order[first[large:more[k]] + k])
    if large:
        ends = np.cumsum(-less[:large])
        starts = ends + less[:large]
        at = np.arange(ends[-1]) + np.repeat(first[:large] - starts, -less[:large])
        out[:large] = np.add.reduceat(np.ascontiguousarray(_take(values, order[at]).T), starts, axis=1).T
    return own[first], out


def _noise_share(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """``weight / (1 + exp(64 * y))`` to single precision; ``y`` is used up.

    exp(2 * y) is a quotient of two polynomials, its 32nd power five squares: a few passes of plain
    arithmetic, as numpy's exponential takes each number by itself on some processors."""
    np.clip(y, -0.5, 0.5, out=y)
    even = y * y
    even *= np.float32(1 / 3)
    even += 1
    share = even + y
    even -= y
    share /= even
    for _ in range(5):
        share *= share
    share += 1
    return np.divide(weight, share, out=share)


class Trainer:
    """Noise-contrastive AdaGrad over weighted trigrams, starting from ``model``, which is changed."""

    def __init__(self, model: Model, unigram: np.ndarray, seed: int):
        self.m, self.rng, n = model, np.random.default_rng(seed), len(unigram)
        self.width = width_of(n)
        blocks = np.add.reduceat(unigram, np.arange(0, n, self.width))
        self.noise_sums = [np.cumsum(p) for p in (unigram, blocks)]
        self.noise_logs = np.concatenate([np.log(NOISE * unigram), np.log(BLOCK_NOISE * blocks)]).astype(np.float32)
        # Symbols and, after them, blocks: one row each, its bias last. The model's arrays are views of them.
        self.rows = np.concatenate([np.column_stack([model.outputs, model.bias]),
                                    np.column_stack([model.block_outputs, model.block_bias])])
        model.outputs, model.bias = self.rows[:n, :DIM], self.rows[:n, DIM]
        model.block_outputs, model.block_bias = self.rows[n:, :DIM], self.rows[n:, DIM]
        self.sums = [np.full_like(x, 1e-3) for x in (model.inputs, model.scales, self.rows)]
        self.seen = np.zeros(n + 1)  # tokens of each symbol; texts for the border
        self.met = np.zeros(n + 1, bool)
        self.tokens = 0

    @staticmethod
    def _step(param: np.ndarray, sums: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
        total = _take(sums, rows)
        total += grad * grad
        sums[rows] = total
        np.sqrt(total, out=total)
        np.divide(grad, total, out=total)
        total *= RATE
        param[rows] = _take(param, rows) - total

    def window(self, symbols: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Learns from all of a window's tokens, each distinct trigram once with its weight."""
        n = len(self.m.inputs) - 1
        bits = n.bit_length()
        if 3 * bits < 64:
            codes = (one.astype(np.int64) << bits | two) << bits | symbols
            pairs = None
        else:  # Contexts are numbered first.
            pairs, pair = np.unique(one.astype(np.int64) << bits | two, return_inverse=True)
            codes = pair.astype(np.int64) << bits | symbols
        codes.sort()
        first = np.concatenate([[0], np.flatnonzero(codes[1:] != codes[:-1]) + 1])
        order = self.rng.permutation(len(first))
        codes, counts = codes[first[order]], np.diff(first, append=len(codes))[order].astype(np.float32)
        self.tokens += len(symbols)
        self.seen += np.bincount(symbols, minlength=n + 1)
        self.seen[n] += np.count_nonzero(one == n)
        low = (1 << bits) - 1
        for at in range(0, len(codes), BATCH):
            c = codes[at:at + BATCH]
            before = c >> bits if pairs is None else pairs[c >> bits]
            self._batch(c & low, before >> bits, before & low, counts[at:at + BATCH])

    def _noise(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows of distinct noise symbols and blocks and how often each is drawn."""
        found = []
        for sums, draws in zip(self.noise_sums, (NOISE, BLOCK_NOISE)):
            drawn = np.searchsorted(sums, self.rng.random(draws) * sums[-1], side="right")
            found.append(np.unique(np.minimum(drawn, len(sums) - 1), return_counts=True))
        (symbols, times), (blocks, more) = found
        return np.concatenate([symbols, blocks + len(self.m.bias)]), np.concatenate([times, more]).astype(np.float32)

    def _batch(self, w: np.ndarray, one: np.ndarray, two: np.ndarray, weight: np.ndarray) -> None:
        m, n, k = self.m, len(self.m.bias), len(w)
        order = np.argsort(w.astype(np.uint16 if n <= 1 << 16 else np.int32), kind="stable")  # a block's symbols meet
        w, one, two, weight = w[order], one[order], two[order], weight[order]
        places = np.concatenate([one, two])
        inputs = _take(m.inputs, places).reshape(2, k, DIM)
        context = np.ones((k, DIM + 1), np.float32)  # the last column carries the bias's share
        np.add(inputs[0] * m.scales[0], inputs[1] * m.scales[1], out=context[:, :DIM])
        weight = weight / weight.mean() / len(weight)
        # d loss / d score: P(data | score) for each noise row, P(noise | score) for the true ones.
        noise, times = self._noise()
        spare = -len(noise) % 4  # products are faster if they are even; empty rows have no effect
        drawn = np.concatenate([_take(self.rows, noise), np.zeros((spare, DIM + 1), np.float32)])
        away = np.ascontiguousarray(drawn.T / -64)
        away[DIM, :len(noise)] += self.noise_logs[noise] / 64
        drawn = drawn[:, :DIM] * np.append(times, np.ones(spare, np.float32))[:, None]
        g_context, g_noise = np.empty((k, DIM), np.float32), np.zeros((DIM + 1, len(noise) + spare), np.float32)
        for at in range(0, k, SLICE):
            to = slice(at, at + SLICE)
            share = _noise_share(context[to] @ away, weight[to, None])
            np.matmul(share, drawn, out=g_context[to])
            g_noise += context[to].T @ share
        blocks = n + w // self.width
        edges = [*np.flatnonzero(np.diff(blocks, prepend=-1)).tolist(), k]
        true_rows = np.concatenate([w, blocks[edges[:-1]], noise])
        grad = np.empty((len(true_rows), DIM + 1), np.float32)
        np.multiply(g_noise.T[:len(noise)], times[:, None], out=grad[-len(noise):])
        for own in (w, blocks):
            true = _take(self.rows, own)
            delta = np.einsum("ij,ij->i", context, true) - self.noise_logs[own]
            g_true = -weight / (1 + np.exp(np.clip(delta, -30, 30)))
            true *= g_true[:, None]
            g_context += true[:, :DIM]
            if own is w:
                np.multiply(g_true[:, None], context, out=grad[:k])
        for at, (a, b) in enumerate(zip(edges, edges[1:]), k):
            np.dot(g_true[a:b], context[a:b], out=grad[at])
        rows, grad = _sums_by_row(true_rows, grad, len(self.rows))
        in_rows, g_in = _sums_by_row(places, (g_context * m.scales[:, None]).reshape(2 * k, DIM), n + 1)
        self.met[rows[rows < n]] = True
        self.met[in_rows] = True
        g_scales = np.einsum("ij,pij->pj", g_context, inputs)
        self._step(m.inputs, self.sums[0], in_rows, g_in)
        self._step(m.scales, self.sums[1], np.arange(2), g_scales)
        self._step(self.rows, self.sums[2], rows, grad)

    def weights(self) -> np.ndarray:
        """Of each of the model's rows: its tokens and one, 0 if it was never met; all tokens for scales and blocks."""
        shared = np.full(2 + len(self.m.block_bias), float(self.tokens))
        return np.concatenate([self.seen + self.met, shared]).astype(np.float32)


def contexts_of(symbols: np.ndarray, starts: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols one and two places before each token; ``before`` where a text begins."""
    one, two = np.roll(symbols, 1), np.roll(symbols, 2)
    one[starts] = before
    two[starts] = before
    second = starts + 1
    two[second[second < len(two)]] = before
    return one, two


# --- corpus passes ----------------------------------------------------------------------
def _numbered(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of all texts, each token's number among them, and the tokens of each text."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lengths = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    words = parts.flatten()
    full = pc.not_equal(words, "")  # beside spaces at an end of a text
    if not pc.all(full, min_count=0).as_py():
        at = np.repeat(np.arange(len(lengths)), lengths)[full.to_numpy(zero_copy_only=False)]
        lengths = np.bincount(at, minlength=len(lengths))
        words = words.filter(full)
    words = words.dictionary_encode()
    lengths += 1
    tokens = np.full(int(lengths.sum()), len(words.dictionary), np.int32)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(lengths) - 1] = False
    tokens[inside] = words.indices.to_numpy(zero_copy_only=False)
    return [*words.dictionary.cast(pa.binary()).to_pylist(), END], tokens, lengths


def _chunked(docs: DataFrame) -> DataFrame:
    """One row for each chunk of about CHUNK_BYTES or one longer text, stored: ``chunk``; ``doc_id, held_out`` and
    ``length`` in tokens of its texts; ``tokens``, their words' numbers in the chunk (32 bits each); ``words``, the
    number of its distinct words; and their ``h``, training count ``n`` (0: held out only) and ``tail``, which gives
    their class."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from xxhash import xxh64_intdigest

        pid, chunk, room = TaskContext.get().partitionId(), 0, 0
        parts: list[pa.RecordBatch] = []

        def row() -> pa.RecordBatch:
            own = pa.Table.from_batches(parts).combine_chunks()
            ids, held, texts = (own.column(x).combine_chunks() for x in ("doc_id", "held_out", "text"))
            words, tokens, lengths = _numbered(texts)
            learned = np.repeat(~held.to_numpy(zero_copy_only=False), lengths)
            lists = {"doc_id": ids, "held_out": held, "length": pa.array(lengths),
                     "h": pa.array(np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)),
                     "n": pa.array(np.bincount(tokens[learned], minlength=len(words))),
                     "tail": pa.array(np.fromiter(map(tail_of, words), np.int64, len(words)))}
            return pa.RecordBatch.from_pydict({
                "chunk": pa.array([(pid << 32) | chunk], pa.int64()), "words": pa.array([len(words)], pa.int64()),
                "tokens": pa.array([tokens.tobytes()], pa.binary()),
                **{k: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for k, x in lists.items()}})
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            start = 0
            for i, size in enumerate(sizes.tolist()):
                room += size + 16
                if room > CHUNK_BYTES:
                    if i > start:
                        parts.append(batch.slice(start, i - start))
                    if parts:
                        yield row()
                    parts, start = [], i
                    chunk, room = chunk + 1, size + 16
            if len(sizes) > start:
                parts.append(batch.slice(start))
        if parts:
            yield row()

    # Rows are long: the writer looks at its buffers after each.
    return stored(docs.withColumn("held_out", crc % 7 == 2).mapInArrow(
        run, f"chunk long, words long, tokens binary, doc_id array<{id_type}>, held_out array<boolean>, "
             "length array<long>, h array<long>, n array<long>, tail array<long>"), "lm-chunks",
        **{"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1})


def _chunk_words(chunks: DataFrame) -> DataFrame:
    """``chunk, h, n, tail`` of each distinct word of a chunk, a row each."""
    return chunks.select("chunk", F.inline(F.arrays_zip("h", "n", "tail")))


def _values(column: pa.Array | pa.ChunkedArray, row: int) -> pa.Array:
    """The list in ``row`` of a column of lists."""
    return column[row].values


def _counted(chunks: DataFrame) -> DataFrame:
    """The training counts of all words, stored. The range of hashes is cut into shelves of about SHELF words of
    chunks. ``counts`` holds, per ``chunk`` and ``shelf``, the counts in the whole table of the chunk's words there,
    by hash (64 bits each); a row without a chunk holds a shelf's distinct words: ``h, c, tail``."""
    rows = chunks.agg(F.sum("words")).first()[0] or 0
    bits = max(1, (rows // SHELF).bit_length())

    def shelve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                h, n, tail = (_values(batch.column(x), row).to_numpy() for x in ("h", "n", "tail"))
                order = np.argsort(h, kind="stable")
                h, n, tail = h[order], n[order], tail[order]
                shelf = h >> (64 - bits)
                edges = [0, *(np.flatnonzero(shelf[1:] != shelf[:-1]) + 1).tolist(), len(h)]
                yield pa.RecordBatch.from_pydict({
                    "shelf": pa.array(shelf[edges[:-1]]),
                    "chunk": pa.array(np.full(len(edges) - 1, batch.column("chunk")[row].as_py())),
                    **{k: pa.array([x[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary())
                       for k, x in (("h", h), ("n", n), ("tail", tail))}})

    def count(rows: pa.Table) -> pa.Table:
        parts = {k: [np.frombuffer(x.as_buffer(), np.int64) for x in rows.column(k)] for k in ("h", "n", "tail")}
        h, place = np.unique(np.concatenate(parts["h"]), return_inverse=True)
        c, tail = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
        np.add.at(c, place, np.concatenate(parts["n"]))
        np.maximum.at(tail, place, np.concatenate(parts["tail"]))
        ends = np.cumsum([len(x) for x in parts["h"]])
        own = np.split(c[place], ends[:-1])
        edges = pa.array([0] * (rows.num_rows + 1) + [len(h)], pa.int32())
        return pa.table({
            "shelf": pa.array(rows.column("shelf").to_pylist() + [rows.column("shelf")[0].as_py()], pa.int64()),
            "chunk": pa.array(rows.column("chunk").to_pylist() + [None], pa.int64()),
            "counts": pa.array([x.tobytes() for x in own] + [None], pa.binary()),
            **{k: pa.ListArray.from_arrays(edges, pa.array(x)) for k, x in (("h", h), ("c", c), ("tail", tail))}})

    shelves = chunks.select("chunk", "h", "n", "tail").mapInArrow(
        shelve, "shelf long, chunk long, h binary, n binary, tail binary")
    return stored(shelves.groupBy("shelf").applyInArrow(
        count, "shelf long, chunk long, counts binary, h array<long>, c array<long>, tail array<long>"), "lm-counts")


def vocabulary_of(counts: DataFrame) -> tuple[Vocabulary, pd.DataFrame]:
    """From ``h, c, tail`` (c > 0): the vocabulary, and ``h, c`` of its HOT most frequent words and the end.
    One row per distinct count, per symbol and per class reaches the driver."""
    end_h = signed_hash(END)
    of_words = counts.filter(F.col("h") != end_h)
    end = counts.filter(F.col("h") == end_h).agg(F.sum("c")).first()[0] or 0
    # Words by their count, from the most frequent on: the smallest count whose words all find room.
    steps = of_words.groupBy("c").agg(F.count(F.lit(1)).alias("v")).toPandas().sort_values("c", ascending=False)
    total, distinct = int((steps["c"] * steps["v"]).sum()) + end, int(steps["v"].sum()) + (end > 0)
    outputs = outputs_of(distinct)
    classes = outputs * CLASSES // OUTPUTS
    room = steps["c"][(steps["v"].cumsum() <= outputs - 1 - classes) & (steps["c"] >= MIN_COUNT)]
    least = int(room.min()) if len(room) else total + 1
    top = of_words.filter(F.col("c") >= least).select("h", "c", "tail").toPandas()
    top = top.sort_values(["c", "h"], ascending=[False, True], ignore_index=True)
    by_class = of_words.filter(F.col("c") < least).groupBy((F.col("tail") % classes).alias("k")).agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    n, v = np.zeros(classes), np.zeros(classes)
    n[by_class["k"].to_numpy(int)], v[by_class["k"].to_numpy(int)] = by_class["n"], by_class["v"]
    words = dict(zip(top["h"].to_numpy(np.int64).view(np.uint64).tolist(), range(1 + classes, 1 + classes + len(top))))
    symbols = np.concatenate([[end], n, top["c"].to_numpy(float)]) + 1
    hot = pd.concat([top[["h", "c"]].head(HOT), pd.DataFrame({"h": [end_h], "c": [end]})]).astype(np.int64)
    return Vocabulary(words, symbols / symbols.sum(), n + v + 1, total, distinct), hot


def _train_round(chunks: DataFrame, vocabulary: Vocabulary, model: Model, number: int) -> Model:
    flat, unigram, symbols = model.flat(), vocabulary.unigram, Symbols(vocabulary)
    wide = 2 * DIM + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        trainer = Trainer(Model.of(flat, len(unigram)), unigram, SEED + 1000 * number + pid)
        held: list[tuple[np.ndarray, np.ndarray]] = []  # symbols and lengths of texts to learn from
        size = 0

        def learn() -> None:
            own, lengths = map(np.concatenate, zip(*held))
            trainer.window(own, *contexts_of(own, np.cumsum(lengths) - lengths, len(unigram)))
            held.clear()
        for batch in batches:
            for row in range(batch.num_rows):
                get = {x: _values(batch.column(x), row).to_numpy(zero_copy_only=False)
                       for x in ("held_out", "length", "h", "tail")}
                tokens = np.frombuffer(batch.column("tokens")[row].as_buffer(), np.int32)
                own = symbols.of(get["h"], get["tail"])[tokens[np.repeat(~get["held_out"], get["length"])]]
                lengths = get["length"][~get["held_out"]]
                # A window ends with the text that fills it.
                while len(lengths):
                    ends = np.cumsum(lengths)
                    texts = int(np.searchsorted(ends, WINDOW - size)) + 1
                    part = own[:ends[min(texts, len(ends)) - 1]]
                    held.append((part, lengths[:texts]))
                    own, lengths, size = own[len(part):], lengths[texts:], size + len(part)
                    if size >= WINDOW:
                        learn()
                        size = 0
        if held:
            learn()
        if not trainer.tokens:
            return
        weights = trainer.weights()
        change = trainer.m.rows() - Model.of(flat, len(unigram)).rows()
        for slab, at in enumerate(range(0, len(weights), SLAB)):
            met = np.flatnonzero(weights[at:at + SLAB])
            if len(met):
                yield pa.RecordBatch.from_pydict({
                    "slab": pa.array([slab], pa.int32()), "part": pa.array([pid], pa.int64()),
                    "met": [met.astype(np.uint16).tobytes()], "weight": [weights[at + met].tobytes()],
                    "change": [change[at + met].astype(np.float16).tobytes()]})

    def some(rows: pd.DataFrame) -> pd.DataFrame:
        weight, change = np.zeros(SLAB), np.zeros((SLAB, wide))
        for met, own, moved in zip(rows["met"], rows["weight"], rows["change"]):
            at, own = np.frombuffer(met, np.uint16), np.frombuffer(own, np.float32)
            weight[at] += own
            change[at] += own[:, None] * np.frombuffer(moved, np.float16).reshape(-1, wide)
        return pd.DataFrame({"slab": rows["slab"].iloc[:1], "weight": [weight.tobytes()], "change": [change.tobytes()]})

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        weight = sum(np.frombuffer(x) for x in rows["weight"])
        change = sum(np.frombuffer(x) for x in rows["change"]).reshape(-1, wide) / np.maximum(weight, 1)[:, None]
        return pd.DataFrame({"slab": rows["slab"].iloc[:1], "change": [change.astype(np.float32).tobytes()]})

    # A task returns as much as its rows of the model, so many small tasks are joined.
    tasks = chunks.rdd.getNumPartitions()
    tasks = min(tasks, max(tasks // 4, 2 * chunks.sparkSession.sparkContext.defaultParallelism))
    parts = chunks.select("held_out", "length", "tokens", "h", "tail").coalesce(max(1, tasks)).mapInArrow(
        run, "slab int, part long, met binary, weight binary, change binary")
    sums = (parts.withColumn("g", F.pmod("part", F.lit(max(1, math.isqrt(tasks))))).groupBy("slab", "g")
                 .applyInPandas(some, "slab int, weight binary, change binary"))
    rows = model.rows()
    for got in sums.groupBy("slab").applyInPandas(whole, "slab int, change binary").collect():
        at = got["slab"] * SLAB
        rows[at:at + SLAB] += np.frombuffer(bytes(got["change"]), np.float32).reshape(-1, wide)[:len(rows) - at]
    return Model.of_rows(rows, vocabulary.size)


def score(docs: DataFrame, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Trains on the rows that are not held out (crc32 of the id as text, mod 7, is 2) and scores
    all. A null or empty text is one end token. A null id counts as the empty text
    for the hold-out. Repeated rows are learned from and scored each. Without training rows
    all counts are 0 and the model is uniform over its symbols. Extra columns are ignored.
    """
    chunks = _chunked(pick(docs, doc_id=id_col, text=text_col))
    counted = _counted(chunks)
    words = counted.filter(F.col("chunk").isNull()).select(F.inline(F.arrays_zip("h", "c", "tail")))
    vocabulary, _ = vocabulary_of(words.filter("c > 0"))
    model = Model.fresh(vocabulary)
    for number in range(rounds):
        model = _train_round(chunks, vocabulary, model, number)

    flat, symbols = model.flat(), Symbols(vocabulary)
    size, total, distinct, class_total = vocabulary.size, vocabulary.total, vocabulary.distinct, vocabulary.class_total
    id_type = chunks.schema["doc_id"].dataType.elementType.simpleString()

    def run(texts: pa.Table, counts: pa.Table) -> pa.Table:
        own = [np.frombuffer(x.as_buffer(), np.int64) for x in counts.sort_by("shelf").column("counts")]
        return _score_chunk(texts, np.concatenate(own), Model.of(flat, size), symbols, total, distinct, class_total)

    return chunks.select("chunk", "doc_id", "held_out", "length", "tokens", "h", "tail").groupBy("chunk").cogroup(
        counted.filter(F.col("chunk").isNotNull()).select(F.col("chunk").alias("of"), "shelf", "counts").groupBy("of")
    ).applyInArrow(
        run, f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")


def _score_chunk(texts: pa.Table, counts: np.ndarray, model: Model, symbols: Symbols, total: int, distinct: int,
                 class_total: np.ndarray) -> pa.Table:
    """Rows of the result for the chunk in the one row of ``texts``; ``counts`` are those of its words, by hash."""
    ids, held = (_values(texts.column(x), 0) for x in ("doc_id", "held_out"))
    lengths, hashes, tails = (_values(texts.column(x), 0).to_numpy() for x in ("length", "h", "tail"))
    tokens = np.frombuffer(texts.column("tokens")[0].as_buffer(), np.int32)
    starts = np.cumsum(lengths) - lengths
    count = np.empty(len(hashes), np.int64)
    count[np.argsort(hashes, kind="stable")] = counts
    symbol = symbols.of(hashes, tails)
    base = np.log10((count + 1) / (total + distinct + 1))
    tail = (symbol >= 1) & (symbol <= len(class_total))
    inner = np.zeros(len(hashes))
    inner[tail] = np.log((count[tail] + 1) / class_total[symbol[tail] - 1])
    own = symbol[tokens]
    one, two = contexts_of(own, starts, len(model.bias))
    logs = (model.log_probabilities(own, one, two) + inner[tokens]) / np.log(10)
    return pa.table({
        "doc_id": ids, "held_out": held, "n_tokens": pa.array(lengths),
        "n_known": pa.array(np.add.reduceat((count > 0).astype(np.int64)[tokens], starts)),
        "train_tokens": pa.array(np.full(len(lengths), total, np.int64)),
        "base_score": pa.array(np.add.reduceat(base[tokens], starts)), "score": pa.array(np.add.reduceat(logs, starts))})


def op1(docs: DataFrame) -> DataFrame:
    return score(docs)
