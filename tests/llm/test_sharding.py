"""Byte shards: contiguous, balanced, gapless."""

import zlib

from llm_fixtures import odd_rows

from adlens.llm import sharding
from adlens.llm.common import read_table


def brute(rows, shards=16):
    """(doc_id, size, crc, shard, slot) of (doc_id, text); null ids first, then by size and checksum."""
    items = sorted(((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), i)
                    for i, t in rows), key=lambda x: x[:4])
    total, start, slots, out = sum(x[2] for x in items), 0, {}, []
    for _, _, size, crc, i in items:
        shard = (2 * start + size) * shards // (2 * total)
        out.append((i, size, crc, shard, slots.get(shard, 0)))
        slots[shard] = slots.get(shard, 0) + 1
        start += size
    return sorted(map(str, out))


def _rows(frame):
    return sorted(str((r.doc_id, r["size"], r.text_crc32, r["shard"], r.slot)) for r in frame.collect())


def test_odd_rows_and_empty_table(odd, empty):
    out = sharding.op9(odd)
    assert _rows(out) == brute([(r[0], r[1]) for r in odd_rows()])
    assert sharding.op9(empty).count() == 0


def test_documents(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    out = sharding.op9(docs)
    assert _rows(out) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    rows = out.collect()
    assert all(r.law == "bytes" and r.grown_shard is None for r in rows)


def test_any_number_of_equal_rows_can_share_a_border(spark):
    same = spark.createDataFrame([(None, "same text")] * 1000, "doc_id long, text string")
    out = sharding.byte_shards(same).groupBy("shard").count().collect()
    assert sorted(r["shard"] for r in out) == list(range(16)) and all(62 <= r["count"] <= 63 for r in out)
