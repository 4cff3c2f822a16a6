"""Contiguous, byte-balanced shards from global prefix sums.

Documents (id, size and text checksum, never the text) are range-partitioned by id and stored.
Each partition's total bytes and rows are summed, those totals - one row per partition - give
every partition its global offsets, and a running sum inside each partition turns them into
every document's place in the whole. Shard ``k`` takes the documents whose middle byte lies in
the ``k``-th of ``shards`` equal parts of all bytes, so a shard is off its target by at most one
document and the shards are contiguous in id order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from adlens.llm.common import pick, stored
from adlens.operators.dimensions import join_dimension

SHARDS = 16


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``start`` (bytes before the row) and ``place`` (rows before it) inside each run of ``pid``."""
    pid, start, place = None, 0, 0
    for batch in batches:
        pids = batch.column("pid").to_numpy(zero_copy_only=False)
        sizes = batch.column("size").to_numpy(zero_copy_only=False)
        starts, places = np.empty(len(pids), np.int64), np.empty(len(pids), np.int64)
        borders = [0, *(np.flatnonzero(pids[1:] != pids[:-1]) + 1), len(pids)] if len(pids) else [0]
        for a, b in zip(borders, borders[1:]):
            if pids[a] != pid:
                pid, start, place = pids[a], 0, 0
            ends = np.cumsum(sizes[a:b])
            starts[a:b], places[a:b] = start + ends - sizes[a:b], place + np.arange(b - a)
            start, place = start + int(ends[-1]), place + b - a
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts), pa.array(places)],
                                         [*batch.schema.names, "start", "place"])


def byte_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
                rows_per_partition: int = 2_000_000) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` per row.

    Size is the UTF-8 bytes of the text plus 1, so a null or empty text counts 1. Null ids
    come first; rows with one id are ordered by size, checksum and place in the input, so any
    number of them can share a border. An empty table gives no rows. Fewer documents than
    shards leave some shards empty.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    lean = stored(pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row")), "shard-sizes")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), lean.count() // rows_per_partition + 1)
    order = ["doc_id", "size", "text_crc32", "_row"]
    placed = stored(lean.repartitionByRange(n, *order).sortWithinPartitions(*order)
                        .withColumn("pid", F.spark_partition_id()).drop("_row")
                        .mapInArrow(_running, lean.drop("_row").withColumn("pid", F.lit(0)).schema
                                    .add("start", "long").add("place", "long")), "shard-places")
    # One row per partition, so bounded by the partition count, not by the documents.
    totals = placed.groupBy("pid").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored(totals.select("pid", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"),
                            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows0"),
                            F.sum("bytes").over(W.partitionBy()).alias("all_bytes")), "shard-offsets")
    middle = "2 * (bytes0 + start) + size"
    cut = stored(join_dimension(placed, offsets, "pid", "inner").select(
        "doc_id", "size", "text_crc32", F.expr(f"({middle}) * {shards} div (2 * all_bytes)").cast("int").alias("shard"),
        (F.col("rows0") + F.col("place")).alias("row")), "shard-cut")
    # At most one row per shard.
    firsts = cut.groupBy("shard").agg(F.min("row").alias("first"))
    return cut.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))


def op9(docs: DataFrame) -> DataFrame:
    return byte_shards(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                    F.lit(None).cast("int").alias("grown_shard"))
