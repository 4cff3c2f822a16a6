"""Line dedup: cuckoo filters, brute force, and deletions that undo insertions."""

import hashlib

import numpy as np
from llm_fixtures import SF, odd_rows
from pyspark.sql import functions as F

from adlens.llm import line_dedup as L
from adlens.llm.common import pick, read_table

WS = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    """(doc_id, n_lines, n_dropped, kept) of (doc_id, text) rows; null is the last document."""
    order = [(float("inf") if i is None else i, (t or "").split("\n")) for i, t in rows]
    holders = {}
    for i, lines in order:
        for x in lines:
            key = x.strip(WS).translate(LOW)
            if len(key) >= 10:
                holders.setdefault(key, set()).add(i)
    out = []
    for (i, _), (rank, lines) in zip(rows, order):
        kept = [x for x in lines if (k := x.strip(WS).translate(LOW)) not in holders or rank == min(holders[k])]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(map(str, out))


def _rows(frame):
    return sorted(str((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256)) for r in frame.collect())


def test_cuckoo_filter_holds_and_forgets():
    keys = np.random.default_rng(0).integers(-2 ** 63, 2 ** 63, 20_000)
    table = L.cuckoo_build(keys)
    assert L.cuckoo_has(table, keys).all() and (table > 0).sum() == len(keys)
    others = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 20_000)
    assert L.cuckoo_has(table, others).mean() < 0.001
    assert L.cuckoo_delete(table, keys[:500]).all()
    assert L.cuckoo_has(table, keys[500:]).all() and L.cuckoo_has(table, keys[:500]).mean() < 0.01
    same = np.full(8, 12345)
    assert L.cuckoo_has(L.cuckoo_build(same), same).all()


def test_odd_rows_and_empty_table(spark, odd, empty):
    assert _rows(L.op10(odd)) == brute([(r[0], r[1]) for r in odd_rows()])
    assert L.op10(empty).count() == 0
    out = L.drop_shared_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    by_id = {(r.doc_id, r.n_chars): r for r in out.collect()}
    assert (2, None) in by_id and by_id[1, 0].text == ""


def test_insertions_and_deletions_are_reversible(spark):
    docs = pick(read_table(spark, SF, "documents"), doc_id="doc_id", text="text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    old, new = docs.filter("doc_id < 120"), docs.filter("doc_id >= 120")
    ledger = L.LineLedger(spark).insert(new).insert(old)
    back = ledger.delete(old.select("doc_id"))

    def state(x):
        return sorted(map(str, x.refs.select("k1", "k2", "refs", "first", "last").collect()))
    assert state(back) == state(L.LineLedger(spark).insert(new))

    def result(x, part):
        return _rows(x.dedup(part, "doc_id", "text").select(
            "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
            F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256")))
    assert result(ledger, docs) == brute(rows)
    assert result(back, new) == brute([r for r in rows if r[0] >= 120])
    again = back.insert(old)
    assert state(again) == state(ledger)


def test_false_positives_survive_insert_delete_insert(spark):
    """Marks of two bits: many new keys are taken for known."""
    def docs(a, b, step=1):
        return spark.createDataFrame([(i, f"a line of its own {i}\nin pairs of documents {i // 2}")
                                      for i in range(a, b, step)], "doc_id long, text string")

    def state(x):
        rows = x.refs.select("k1", "k2", "refs", "first", "last").collect()
        return sorted(map(str, rows))

    def marks(x):
        return sum(int((L._table(r.payload) > 0).sum()) for r in x.filters.collect())
    both = L.LineLedger(spark, mark_bits=2).insert(docs(0, 600)).insert(docs(600, 1200))
    assert marks(both) == both.refs.count() == 1800
    some = both.delete(docs(0, 1200, 3).select("doc_id"))
    assert marks(some) == some.refs.count()
    again = some.insert(docs(0, 1200, 3))
    assert state(again) == state(L.LineLedger(spark).insert(docs(0, 1200)))
    assert marks(again) == again.refs.count() == again.refs.select("k1", "k2").distinct().count()


def test_batch_deletion_clears_one_mark_a_key():
    rng = np.random.default_rng(2)
    for bits in (2, 4, 16):
        keys = rng.integers(-2 ** 63, 2 ** 63, 3000)
        table = L.cuckoo_build(keys, bits)
        gone = rng.permutation(3000) < 1200
        assert L.cuckoo_delete(table, keys[gone], bits).all()
        assert (table > 0).sum() == 1800 and L.cuckoo_has(table, keys[~gone], bits).all()
    same = L.cuckoo_build(np.full(8, 77))
    assert L.cuckoo_delete(same, np.full(10, 77)).sum() == 8 and not same.any()


def test_a_ledger_of_many_inserts_stays_bounded_and_exact(spark, monkeypatch):
    """Ten inserts with deletions between: generations are merged, shards cut anew, counts exact."""
    monkeypatch.setattr(L, "MIN_SHARDS", 2)
    monkeypatch.setattr(L, "KEYS_PER_SHARD", 40)
    monkeypatch.setattr(L, "GENERATIONS", 3)
    texts = {i: f"a line that only {i} has\nshared by some of them {i % 7}\nshared by all of the documents" for i in range(200)}
    held, ledger, shards = {}, L.LineLedger(spark), []
    for day in range(10):
        new = {i: texts[i] for i in range(20 * day, 20 * day + 20)}
        ledger = ledger.insert(spark.createDataFrame(list(new.items()), "doc_id long, text string"))
        held |= new
        if day % 3 == 2:
            gone = [i for i in held if i % 5 == day % 5]
            ledger = ledger.delete(spark.createDataFrame([(i,) for i in gone], "doc_id long"))
            held = {i: t for i, t in held.items() if i not in gone}
        per_shard = {}
        marks = 0
        for r in ledger.filters.collect():
            per_shard[r.shard] = per_shard.get(r.shard, 0) + 1
            marks += int((L._table(r.payload) > 0).sum())
        assert marks == ledger.refs.count() <= ledger.keys and max(per_shard.values()) <= 3
        shards.append(ledger.shards)
    assert shards[0] == 2 and shards[-1] >= 4 and max(per_shard) < ledger.shards
    whole = L.LineLedger(spark).insert(spark.createDataFrame(list(held.items()), "doc_id long, text string"))
    state = [sorted(map(str, x.refs.select("k1", "k2", "refs", "nulls", "first", "last").collect())) for x in (ledger, whole)]
    assert state[0] == state[1]
    assert L.LineLedger(spark).merged().refs is None
