"""Reversible incremental line dedup: sharded cuckoo filters over exact reference counts.

A ledger holds three tables, all written under the shared checkpoint folder:

* ``holders`` (doc_id, key): which document holds which line key;
* ``refs`` (key -> references, smallest and largest holder, generation): the exact counts;
* ``filters`` (shard, generation -> cuckoo filter): a few bits per key.

Inserting documents sums their keys first (a line that a third of all documents share arrives
as one row), then each shard probes its filters: a key that no filter knows is certainly new
and is appended as it is, only the others are merged with the exact counts. The keys that the counts
did not hold, also those that a filter took for known, become the shard's next filter generation, so
stored filters are never half-written. A shard's generations are merged into one filter after GENERATIONS
inserts, and the shards are cut anew when their keys outgrow them, so a probe reads a bounded number of filters
of a bounded size however old the ledger is. Deleting documents takes their holders away, recounts just the
keys they held and removes keys without holders from the filter of their own generation, so every mark
is one living key's. False positives of a filter cost one exact look-up and never change a result.

Keys are 128-bit hashes of the stripped, lower-cased line.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import Positional, lower_ascii, pick, stored, strip_spaces

MIN_CHARS = 10
KEYS_PER_SHARD = 100_000
MIN_SHARDS = 64
# Inserts after which the filters of a shard are merged, and how far shards may outgrow KEYS_PER_SHARD before.
GENERATIONS = 8
OVERFULL = 4
_SLOTS = 4
MARK_BITS = 16
_KEY = ["k1", "k2"]


# --- cuckoo filter: four 16-bit slots per bucket, 0 = free ------------------------------
def _places(hashes: np.ndarray, buckets: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = hashes.view(np.uint64)
    mark = (h >> np.uint64(64 - bits)).astype(np.uint16)
    mark[mark == 0] = 1
    return mark, (h & np.uint64(buckets - 1)).astype(np.int64)


def _other(at: np.ndarray, mark: np.ndarray, buckets: int) -> np.ndarray:
    spread = mark.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
    return at ^ (spread & np.uint64(buckets - 1)).astype(np.int64)


def cuckoo_build(hashes: np.ndarray, bits: int = MARK_BITS) -> np.ndarray:
    """A filter of ``hashes`` (int64): buckets x 4 marks. Whole batches are placed at once; of
    the marks that compete for a bucket one wins per step, the rest go to their other bucket or
    push a mark out. A filter that will not settle is built again with twice the buckets."""
    buckets = 1 << max(2, int(np.ceil(np.log2(max(1, len(hashes)) / (_SLOTS * 0.8)))))
    while True:
        table = np.zeros((buckets, _SLOTS), np.uint16)
        mark, at = _places(hashes, buckets, bits)
        for turn in range(500):
            for slot in range(_SLOTS):
                if not len(at):
                    return table
                free = np.flatnonzero(table[at, slot] == 0)
                won = free[np.unique(at[free], return_index=True)[1]]
                table[at[won], slot] = mark[won]
                at, mark = np.delete(at, won), np.delete(mark, won)
            if not len(at):
                return table
            if turn % 2:  # both buckets are full: one mark per bucket is pushed out
                won = np.unique(at, return_index=True)[1]
                slot = (turn // 2 + mark[won]) % _SLOTS
                out = table[at[won], slot].copy()
                table[at[won], slot] = mark[won]
                mark[won] = out
            at = _other(at, mark, buckets)
        buckets *= 2


def cuckoo_has(table: np.ndarray, hashes: np.ndarray, bits: int = MARK_BITS) -> np.ndarray:
    mark, at = _places(hashes, len(table), bits)
    both = (table[at] == mark[:, None]) | (table[_other(at, mark, len(table))] == mark[:, None])
    return both.any(axis=1)


def cuckoo_delete(table: np.ndarray, hashes: np.ndarray, bits: int = MARK_BITS) -> np.ndarray:
    """Which of ``hashes`` were found; one mark of each is cleared in ``table``."""
    mark, at = _places(hashes, len(table), bits)
    found, left = np.zeros(len(hashes), bool), np.arange(len(hashes))
    for bucket in (at, _other(at, mark, len(table))):
        for slot in range(_SLOTS):
            hit = left[table[bucket[left], slot] == mark[left]]
            won = hit[np.unique(bucket[hit], return_index=True)[1]]  # one mark serves one hash
            table[bucket[won], slot] = 0
            found[won] = True
            left = left[~found[left]]
    return found


def _table(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, np.uint16).reshape(-1, _SLOTS).copy()


# --- lines ------------------------------------------------------------------------------
def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _keyed(lines: Column) -> Column:
    """(pos, k1, k2) of the lines whose key is long enough."""
    keys = F.transform(lines, lambda x, i: F.struct(lower_ascii(strip_spaces(x)).alias("key"), i.alias("pos")))
    long = F.filter(keys, lambda s: F.char_length(s["key"]) >= MIN_CHARS)
    return F.transform(long, lambda s: F.struct(
        s["pos"].alias("pos"), F.xxhash64(s["key"]).alias("k1"), F.xxhash64(F.lit("line"), s["key"]).alias("k2")))


def _holders(docs: DataFrame) -> DataFrame:
    """``doc_id, k1, k2``: each key once per row of ``docs`` (``doc_id, text``)."""
    keys = F.array_distinct(F.transform(_keyed(split_lines(F.col("text"))),
                                        lambda s: F.struct(s["k1"].alias("k1"), s["k2"].alias("k2"))))
    return docs.select("doc_id", F.explode(keys).alias("k")).select("doc_id", "k.k1", "k.k2")


def _counted(holders: DataFrame) -> DataFrame:
    return holders.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("refs"), F.count_if(F.col("doc_id").isNull()).alias("nulls"),
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


@dataclass(frozen=True)
class LineLedger:
    """An immutable state; ``insert`` and ``delete`` return the next one."""
    spark: SparkSession
    holders: DataFrame | None = None
    refs: DataFrame | None = None
    filters: DataFrame | None = None
    shards: int = 0
    generation: int = 0
    mark_bits: int = MARK_BITS
    stacked: int = 0   # filter generations since the last merge
    keys: int = 0      # upper bound of the living keys

    def _sharded(self, frame: DataFrame, shards: int) -> DataFrame:
        return frame.withColumn("shard", F.pmod("k2", F.lit(shards)).cast("int"))

    def _filters_of(self, refs: DataFrame, shards: int) -> DataFrame:
        """One filter per shard over the keys of ``refs``, which are of one generation."""
        bits = self.mark_bits

        def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"shard": rows["shard"].iloc[:1], "generation": rows["generation"].iloc[:1],
                                 "payload": [cuckoo_build(rows["k1"].to_numpy(), bits).tobytes()]})
        keys = self._sharded(refs.select("generation", *_KEY), shards).select("shard", "generation", "k1")
        return stored(keys.groupBy("shard").applyInPandas(build, _FILTERS), "ledger-filters")

    def merged(self) -> LineLedger:
        """The same ledger with one filter generation and shards cut by its living keys. An empty
        ledger stays as it is; counts and holders never change."""
        if self.refs is None:
            return self
        refs = stored(self.refs.withColumn("generation", F.lit(self.generation)), "ledger-refs")
        keys = refs.count()
        shards = max(MIN_SHARDS, -(-keys // KEYS_PER_SHARD))
        return replace(self, refs=refs, filters=self._filters_of(refs, shards), shards=shards,
                       generation=self.generation + 1, stacked=1, keys=keys)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineLedger:
        """The ledger with ``docs`` added. Null and empty texts hold no keys; a row that
        is inserted twice counts twice and needs one delete."""
        new = stored(_holders(pick(docs, doc_id=id_col, text=text_col)), "ledger-holders")
        counted = stored(_counted(new), "ledger-batch")
        arrived = counted.count()
        shards = self.shards or max(MIN_SHARDS, arrived // KEYS_PER_SHARD)
        bits, fresh = self.mark_bits, counted.withColumn("generation", F.lit(self.generation))
        filters = self.filters if self.filters is not None else self.spark.createDataFrame([], _FILTERS)

        def probe(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            hashes = rows["k1"].to_numpy()
            maybe = np.zeros(len(rows), bool)
            for payload in known["payload"]:
                maybe |= cuckoo_has(_table(payload), hashes, bits)
            return rows[maybe][_KEY]

        if self.refs is None:
            refs = fresh
        else:
            batch = self._sharded(counted.select(*_KEY), shards)
            maybe = stored(batch.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(
                probe, "k1 long, k2 long"), "ledger-probes")
            exact = self.refs.unionByName(fresh.join(maybe, _KEY, "left_semi")).groupBy(*_KEY).agg(
                F.sum("refs").alias("refs"), F.sum("nulls").alias("nulls"),
                F.min("first").alias("first"), F.max("last").alias("last"), F.min("generation").alias("generation"))
            refs = stored(exact.unionByName(fresh.join(maybe, _KEY, "left_anti")), "ledger-refs")
        # What the exact look-up has not found is new, whatever the filters said of it.
        added = self._filters_of(refs.filter(F.col("generation") == self.generation), shards)
        ledger = LineLedger(self.spark, new if self.holders is None else self.holders.unionByName(new), refs,
                            filters.unionByName(added), shards, self.generation + 1, bits, self.stacked + 1,
                            self.keys + arrived)
        outgrown = ledger.keys > OVERFULL * KEYS_PER_SHARD * shards
        return ledger.merged() if outgrown or ledger.stacked > GENERATIONS else ledger

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> LineLedger:
        """The ledger without the documents of ``ids``; unknown and null ids change nothing."""
        if self.refs is None:
            return self
        gone = pick(ids, doc_id=id_col).distinct()
        left = stored(self.holders.join(gone, "doc_id", "left_anti"), "ledger-holders")
        touched = stored(self.holders.join(gone, "doc_id", "left_semi").select(*_KEY).distinct(), "ledger-touched")
        marked = self.refs.join(touched, _KEY, "left_semi").select(*_KEY, "generation")
        again = stored(_counted(left.join(touched, _KEY, "left_semi")).join(marked, _KEY), "ledger-recount")
        refs = stored(self.refs.join(touched, _KEY, "left_anti").unionByName(again), "ledger-refs")
        dead = self._sharded(marked.join(again, _KEY, "left_anti"), self.shards)
        bits = self.mark_bits

        def clear(key: tuple, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            done = []
            for generation, payload in zip(known["generation"], known["payload"]):
                table = _table(payload)
                cuckoo_delete(table, rows["k1"][rows["generation"] == generation].to_numpy(), bits)
                done.append(table.tobytes())
            return known.assign(payload=done)

        filters = stored(dead.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(
            clear, _FILTERS), "ledger-filters")
        return replace(self, holders=left, refs=refs, filters=filters)

    def drops(self, rows: DataFrame) -> DataFrame:
        """``r1, r2, drops`` (line positions) for ``rows`` (``r1, r2, doc_id, text``) that lose lines."""
        shared = self.refs.filter((F.col("first") < F.col("last")) | (F.col("first").isNotNull() & (F.col("nulls") > 0)))
        lines = rows.select("r1", "r2", "doc_id", F.explode(_keyed(split_lines(F.col("text")))).alias("k")).select(
            "r1", "r2", "doc_id", "k.*")
        lost = lines.join(shared.select(*_KEY, "first"), _KEY).filter(
            F.col("doc_id").isNull() | (F.col("doc_id") != F.col("first")))
        return lost.select("r1", "r2", "pos").distinct().groupBy("r1", "r2").agg(F.collect_list("pos").alias("drops"))

    def dedup(self, frame: DataFrame, doc_id: str, text: str) -> DataFrame:
        """``frame`` with ``_n_lines, _n_dropped, _kept`` (the text that stays)."""
        # Rows alike in id and text lose the same lines, so a hash of both can name the row.
        named = frame.withColumns({"r1": F.xxhash64(doc_id, text), "r2": F.xxhash64(F.lit("row"), doc_id, text)})
        drops = self.drops(named.select("r1", "r2", F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
        own = F.coalesce(F.col(text), F.lit(""))
        cut = _cut(F.when(F.col("drops").isNotNull(), own), F.col("drops"))
        return (named.join(stored(drops, "ledger-drops"), ["r1", "r2"], "left")
                     .withColumns({"_n_lines": F.size(split_lines(F.col(text))).cast("long"),
                                   "_n_dropped": F.coalesce(F.size("drops"), F.lit(0)).cast("long"),
                                   "_kept": F.coalesce(cut, own)}).drop("r1", "r2", "drops"))


_FILTERS = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("generation", T.IntegerType()),
                         T.StructField("payload", T.BinaryType())])


def _cut(text: Column, drops: Column) -> Column:
    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for t, lost in zip(texts, lists):
            if lost is None or t is None:
                out.append(None)
                continue
            lost = set(map(int, lost))
            out.append("\n".join(x for i, x in enumerate(t.split("\n")) if i not in lost))
        return pd.Series(out, dtype=object)
    return cut(text, drops)


def load(docs: DataFrame, batches: int = 2, id_col: str = "doc_id", text_col: str = "text") -> LineLedger:
    """A ledger of all of ``docs``, inserted in ``batches`` increments by a hash of the id."""
    ledger = LineLedger(docs.sparkSession)
    named = pick(docs, doc_id=id_col, text=text_col)
    for k in range(batches):
        ledger = ledger.insert(named.filter(F.pmod(F.xxhash64("doc_id"), F.lit(batches)) == k))
    return ledger


def drop_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every line gone that a document with a smaller id holds, too.

    A null text stays null and holds nothing; an empty text is one empty line. Rows with one
    id are one document; rows with a null id are one document that comes last. An empty table
    gives no rows. Other columns stay as they are, but ``n_chars`` follows the text.
    """
    p = Positional(docs)
    ledger = load(docs, id_col=id_col, text_col=text_col)
    out = ledger.dedup(p.frame, p[id_col], p[text_col])
    out = out.withColumn(p[text_col], F.when(F.col(p[text_col]).isNotNull(), F.col("_kept")))
    if "n_chars" in p.names:
        kind = dict(p.frame.dtypes)[p["n_chars"]]
        out = out.withColumn(p["n_chars"], F.when(
            F.col("_n_dropped") > 0, F.char_length(p[text_col]).cast(kind)).otherwise(F.col(p["n_chars"])))
    return p.restore(out)


def op10(docs: DataFrame) -> DataFrame:
    base = pick(docs, doc_id="doc_id", text="text")
    return load(base).dedup(base, "doc_id", "text").select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
        F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key
      HAVING count(DISTINCT coalesce(doc_id, -1)) > 1),
m AS (SELECT k.*, s.first IS NOT NULL AND doc_id IS DISTINCT FROM s.first AS lost FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id
"""
