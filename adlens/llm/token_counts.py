"""Edit-aware token counts over segment trees of pre-tokens.

A document's text is cut into segments at safe pre-token borders (see ``bpe.pieces``), and
each segment is a leaf of a segment tree that keeps characters and tokens of every subtree. An
edit walks down to the leaves it touches, widens the region to the leaf borders - which
no pre-token crosses - and, where the new text has no border at its end, by the next leaf;
only that region is encoded again, and the sums on the paths to the root are updated. A leaf
that grows beyond its bound is cut anew and its part of the tree rebuilt, unencoded.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.bpe import _BORDER, encoder, pieces
from adlens.llm.common import pick

SEGMENT_CHARS = 512


class TokenTree:
    """Segments of one text under a binary tree of (characters, tokens) sums.

    ``nodes[1]`` is the root, the children of ``i`` are ``2i`` and ``2i + 1``, and leaf ``k``
    is node ``width + k``. ``encoded`` counts the characters ever given to the encoder.
    """

    def __init__(self, text: str, count, size: int = SEGMENT_CHARS):
        self.count, self.size, self.encoded = count, size, 0
        self.parts = list(pieces(text, size))
        self._build([self._tokens(p) for p in self.parts])

    def _tokens(self, part: str) -> int:
        self.encoded += len(part)
        return self.count(part)

    def _build(self, tokens: list[int]) -> None:
        self.width = 1 << max(0, len(self.parts) - 1).bit_length()
        pad = self.width - len(self.parts)
        self.chars = [0] * self.width + [len(p) for p in self.parts] + [0] * pad
        self.tokens = [0] * self.width + tokens + [0] * pad
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` (the last one for the end), and its first character."""
        i, first = 1, 0
        while i < self.width:
            i *= 2
            if at - first >= self.chars[i] and self.chars[i + 1]:
                first += self.chars[i]
                i += 1
        return i - self.width, first

    def _set(self, k: int, part: str, tokens: int) -> None:
        self.parts[k] = part
        i = self.width + k
        self.chars[i], self.tokens[i] = len(part), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.parts)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces characters ``start`` to ``stop`` (clipped to the text) by ``new``."""
        start = min(max(start, 0), self.chars[1])
        stop = min(max(stop, start), self.chars[1])
        a, first = self._leaf(start)
        # The border before leaf `a` depends on the characters on both of its sides: if the edit
        # touches the leaf's first characters, the leaf before it comes in.
        if start == first and a:
            a = self._before(a)
            first -= len(self.parts[a])
        b, b_first = self._leaf(stop)
        region = "".join(self.parts[a:b + 1])
        region = region[:start - first] + new + region[stop - first:]
        while (nxt := self._after(b)) is not None and not self._border(region, self.parts[nxt]):
            b = nxt
            region += self.parts[b]
        if len(region) > 4 * self.size:
            cut = list(pieces(region, self.size))
            self.parts[a:b + 1] = cut
            tokens = self.tokens[self.width:self.width + len(self.parts) - len(cut) + b + 1 - a]
            tokens[a:b + 1] = [self._tokens(p) for p in cut]
            self._build(tokens)
            return
        self._set(a, region, self._tokens(region))
        for k in range(a + 1, b + 1):
            if self.parts[k]:
                self._set(k, "", 0)

    def _before(self, k: int) -> int:
        k -= 1
        while k and not self.parts[k]:
            k -= 1
        return k

    def _after(self, k: int) -> int | None:
        for j in range(k + 1, len(self.parts)):
            if self.parts[j]:
                return j
        return None

    @staticmethod
    def _border(left: str, right: str) -> bool:
        """Whether the place between two non-empty neighbours is a safe border."""
        return bool(left) and _BORDER.match(left[-1] + right[0], 1) is not None


def edited_counts(docs: DataFrame, ranks: str, pattern: str, edits_col: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after, n_chars_encoded`` per row.

    ``edits_col`` holds ``array<struct<start int, stop int, new string>>``, applied in
    order, each to the text the ones before it left; positions are characters and are clipped
    to the text. Null texts are empty, null arrays are no edits, null members of an edit are
    0, 0 and the empty string. ``n_chars_encoded`` counts what the edits made the encoder read again.
    """
    base = pick(docs, doc_id=id_col, text=text_col, edits=edits_col)
    id_type = base.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, n_edits long, n_tokens_after long, n_chars_after long, n_chars_encoded long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks, pattern)

        def count(part: str) -> int:
            return len(enc.encode_ordinary(part))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = []
                for text, edits in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    tree = TokenTree(text or "", count)
                    before, first = tree.n_tokens, tree.encoded
                    for e in edits or []:
                        e = e or {}
                        tree.edit(e.get("start") or 0, e.get("stop") or 0, e.get("new") or "")
                    rows.append((before, len(edits or []), tree.n_tokens, tree.chars[1], tree.encoded - first))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 5))],
                    ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_chars_encoded"])

    return base.mapInArrow(run, schema)


def revision(text: Column) -> Column:
    """Edits of a text, derived from it alone: up to 200 of its last characters are copied to the
    front; a quarter in, 40 characters go; halfway, 20 are written in capitals and doubled."""
    n = F.char_length(text)

    def edit(start: Column, stop: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), new.alias("new"))
    tail = F.substring(text, n - F.floor(n / 10).cast("int") + 1, F.least(F.lit(200), F.floor(n / 10).cast("int")))
    middle = F.upper(F.substring(text, F.floor(n / 2).cast("int") + 1, F.lit(20)))
    return F.array(edit(F.lit(0), F.lit(0), tail), edit(F.floor(n / 4), F.floor(n / 4) + 40, F.lit("")),
                   edit(F.floor(n / 2), F.floor(n / 2) + 20, F.concat(middle, middle)))


def op7(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    base = pick(docs, doc_id="doc_id", text="text")
    return edited_counts(base.withColumn("edits", revision(F.coalesce(F.col("text"), F.lit("")))), ranks, pattern, "edits")
