"""SimHash near-dedup by a binary trie self-join.

Fingerprints are read bit by bit from the top, so every bit string is a node of a binary trie.
Two nodes are traversed together: their differing bits add up on the way down, and a pair of
nodes is dropped as soon as it differs in more bits than allowed. The upper levels run as Spark
jobs on (node, node) rows that hold counts only; a pair goes down further while it holds more
fingerprints than one task should see, however common its prefix is. Each pair that is small
enough becomes one task: its fingerprints are sorted and the traversal goes on over ranges of
the sorted arrays, down to single fingerprints. Equal fingerprints are one leaf, so copies
never meet each other as pairs; they share their leaf's component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import Positional, pick, stored
from adlens.operators.components import connected_components
from adlens.operators.dimensions import is_broadcastable

SHINGLE = 3
DISTANCE = 2
# Fingerprints of both nodes together that one task traverses; bits per level of the Spark part.
TASK_FINGERPRINTS = 32_768
STEP = 2
_BLOCK = 1 << 16
_NODES = 1 << 16
_BRUTE = 16


def fingerprint(text: str | None, k: int = SHINGLE) -> int:
    """The signed 64-bit SimHash of a text: shingles of ``k`` words, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < k:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(k)))))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        part = shingles[at:at + _BLOCK]
        hashes = np.fromiter(map(partial(xxh64_intdigest, seed=42), part), np.uint64, len(part))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    major = np.packbits(2 * ones > len(shingles), bitorder="little")
    return int(major.view(np.int64)[0])


def fingerprint_column(text: Column, k: int = SHINGLE) -> Column:
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, k) for t in texts], dtype="int64")
    return prints(text)


def _expand(lo_a, hi_a, lo_b, hi_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All index pairs of many small ranges, and the number of the range pair of each."""
    wide = hi_b - lo_b
    sizes = (hi_a - lo_a) * wide
    owner = np.repeat(np.arange(len(sizes)), sizes)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return lo_a[owner] + nth // wide[owner], lo_b[owner] + nth % wide[owner], owner


def trie_pairs(a: np.ndarray, b: np.ndarray, depth: int, most: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of the sorted unsigned arrays ``a`` and ``b`` that differ in at most ``most``
    bits. Each array's members share their first ``depth`` bits. ``same``: both are one array,
    and each pair is wanted once. Node pairs are kept in bounded blocks, deepest first."""
    if not len(a) or not len(b):
        return
    start = int(np.bitwise_count((a[0] >> np.uint64(64 - depth)) ^ (b[0] >> np.uint64(64 - depth)))) if depth else 0
    one = lambda x: np.array([x], np.int64)
    stack = [(depth, one(0), one(len(a)), one(0), one(len(b)), one(start), np.array([same]))]
    while stack:
        level, la, ha, lb, hb, bits, own = stack.pop()
        leaf = (ha - la) * (hb - lb) <= _BRUTE
        if leaf.any():
            i, j, owner = _expand(la[leaf], ha[leaf], lb[leaf], hb[leaf])
            good = (np.bitwise_count(a[i] ^ b[j]) <= most) & (~own[leaf][owner] | (i < j))
            yield i[good], j[good]
            la, ha, lb, hb, bits, own = (x[~leaf] for x in (la, ha, lb, hb, bits, own))
        if not len(la):
            continue
        # Inside a node bit `level` splits the range: members with a 0 come first.
        s = np.uint64(63 - level)
        ma = np.searchsorted(a, ((a[la] >> s) | np.uint64(1)) << s)
        mb = np.searchsorted(b, ((b[lb] >> s) | np.uint64(1)) << s)
        no = np.zeros(len(la), bool)
        down = [(la, ma, lb, mb, bits, own), (ma, ha, mb, hb, bits, own),
                (la, ma, mb, hb, bits + 1, no),
                tuple(x[~own] for x in (ma, ha, lb, mb, bits + 1, no))]
        la, ha, lb, hb, bits, own = (np.concatenate(x) for x in zip(*down))
        live = (ha > la) & (hb > lb) & (bits <= most)
        nodes = [x[live] for x in (la, ha, lb, hb, bits, own)]
        for at in range(0, len(nodes[0]), _NODES):
            stack.append((level + 1, *(x[at:at + _NODES] for x in nodes)))


def _prefix(fp: str, depth: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def hamming_links(prints: DataFrame, distance: int = DISTANCE, task_rows: int = TASK_FINGERPRINTS) -> DataFrame:
    """``a, b``: every pair of the distinct longs ``fp`` within ``distance`` bits, once."""
    front = prints.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("bits"),
        F.col("n").alias("na"), F.col("n").alias("nb"))
    tasks, depths, depth = None, [], 0
    while True:
        front = stored(front, "simhash-nodes")
        large = F.col("na") + F.col("nb") > task_rows
        ready = front.filter(~large).select(F.lit(depth).alias("depth"), "a", "b")
        tasks = ready if tasks is None else tasks.unionByName(ready)
        depths.append(depth)
        front = front.filter(large)
        if depth == 64 or front.isEmpty():
            break
        depth += STEP
        counts = stored(prints.groupBy(_prefix("fp", depth).alias("c")).agg(F.count(F.lit(1)).alias("n"))
                              .withColumn("up", F.shiftrightunsigned("c", STEP) if depth > STEP
                                          else F.lit(0).cast("long")), "simhash-counts")
        left = counts.select(F.col("up").alias("a"), F.col("c").alias("ca"), F.col("n").alias("cna"))
        right = counts.select(F.col("up").alias("b"), F.col("c").alias("cb"), F.col("n").alias("cnb"))
        bits = F.col("bits") + F.bit_count(F.col("ca").bitwiseXOR(F.col("cb")).bitwiseAND(F.lit((1 << STEP) - 1)))
        front = (front.join(left, "a").join(right, "b")
                      .filter((F.col("a") != F.col("b")) | (F.col("ca") <= F.col("cb")))
                      .select(F.col("ca").alias("a"), F.col("cb").alias("b"), bits.alias("bits"),
                              F.col("cna").alias("na"), F.col("cnb").alias("nb")).filter(F.col("bits") <= distance))
    tasks = stored(tasks, "simhash-tasks")
    sides = tasks.select("depth", "a", "b", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.lit(0)))
                                                       .otherwise(F.array(F.lit(0), F.lit(1)))).alias("side"))
    sides = sides.withColumn("node", F.when(F.col("side") == 0, F.col("a")).otherwise(F.col("b")))
    sides = F.broadcast(sides) if is_broadcastable(sides) else sides
    # A node of any task has at most task_rows members: they travel as one row, to each of its tasks.
    members = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), _prefix("fp", d).alias("node")) for d in depths])).alias("x")).select("fp", "x.*")
    pages = (members.join(sides.select("depth", "node").distinct(), ["depth", "node"], "left_semi")
                    .groupBy("depth", "node").agg(F.collect_list("fp").alias("fps")))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        depth, a, b = (int(x) for x in key)
        page = {side: np.sort(np.asarray(fps, np.int64).view(np.uint64)) for side, fps in zip(rows["side"], rows["fps"])}
        left, right = page[0], page[0 if a == b else 1]
        none = np.empty(0, np.uint64)
        pairs = [(none, none), *((left[i], right[j]) for i, j in trie_pairs(left, right, depth, distance, a == b))]
        a_side, b_side = (np.concatenate(x).view(np.int64) for x in zip(*pairs))
        return pd.DataFrame({"a": a_side, "b": b_side})

    return pages.join(sides, ["depth", "node"]).groupBy("depth", "a", "b").applyInPandas(run, "a long, b long")


def components(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``fp, component_id, keeper`` per distinct fingerprint of ``prints`` (``doc_id, fp, row``):
    the smallest non-null id and the first row (by id, nulls last, then place) of its component."""
    leaves = stored(prints.groupBy("fp").agg(
        F.min("doc_id").alias("doc_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "row")).alias("keeper")), "simhash-leaves")
    links = stored(hamming_links(leaves.select("fp"), distance), "simhash-links")
    labels = stored(connected_components(links, leaves, "a", "b", "fp").withColumnRenamed("id", "fp")
                    .join(leaves, "fp"), "simhash-labels")
    best = labels.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("keeper").alias("keeper"))
    return labels.select("fp", "component").join(stored(best, "simhash-components"), "component").select(
        "fp", "component_id", F.col("keeper.row").alias("keeper"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row.

    A null, empty or all-space text has fingerprint zero and links like any other; a text of
    fewer than ``shingle`` words is one shingle. Repeated rows share a fingerprint and so a
    component; null ids take part, but a component's id is its smallest non-null one. An empty
    table gives no rows; extra columns are ignored.
    """
    prints = stored(pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", fingerprint_column(F.col("text"), shingle).alias("fp"),
        F.monotonically_increasing_id().alias("row")), "simhash-prints")
    found = components(prints, distance).select("fp", "component_id")
    return prints.join(found, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that come first (smallest id) in their component."""
    p = Positional(docs)
    table = stored(p.frame.withColumns({"_fp": fingerprint_column(F.col(p[text_col]), shingle),
                                        "_row": F.monotonically_increasing_id()}), "simhash-docs")
    prints = table.select(F.col(p[id_col]).alias("doc_id"), F.col("_fp").alias("fp"), F.col("_row").alias("row"))
    keepers = components(prints, distance).select(F.col("keeper").alias("_row")).distinct()
    return p.restore(table.join(keepers, "_row", "left_semi"))


def op5(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
