"""The mix: targets by water-filling, words near them, odds, reruns."""

import pytest
from llm_fixtures import SF, odd_rows
from pyspark.sql import functions as F

from adlens.llm import mixing
from adlens.llm.common import read_table


def fill(sizes, cycle=(5, 2, 1), share=1.5, limit=2):
    weight = {s: cycle[i % 3] for i, s in enumerate(sizes)}
    out, free, goal = {}, set(sizes), share * sum(sizes.values())
    while True:
        rest = goal - sum(out.values())
        over = [s for s in free if rest * weight[s] / sum(weight[x] for x in free) > limit * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        for s in over:
            out[s] = limit * sizes[s]
            free.discard(s)


def test_targets_match_repeated_resharing(spark):
    sizes = {"a": 100, "b": 5000, "c": 40, "d": 0, "e": 900, "f": 70, None: 300}
    frame = spark.createDataFrame(list(sizes.items()), "_source string, source_size long")
    got = {r["_source"]: r["target"] for r in mixing.targets(frame).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_words_taken_come_near_targets_and_reruns_agree(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    a = mixing.op3(docs)
    rows = a.join(docs.select("doc_id", "source"), "doc_id").collect()
    largest, taken, target = {}, {}, {}
    for r in rows:
        assert r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in taken)
    assert sorted(rows) == sorted(mixing.op3(docs.repartition(7)).join(docs.select("doc_id", "source"), "doc_id").collect())


def test_odd_rows_and_empty_table(spark, odd, empty):
    got = mixing.op3(odd).collect()
    assert len(got) == len(odd_rows()) and all(r.taken == 0 for r in got if r.size == 0)
    assert mixing.op3(empty).count() == 0
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    assert mixed.count() == sum(r.copies for r in got)
    assert mixing.mix(empty).count() == 0


def test_hot_bucket_is_cut_exactly(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), 7).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "s").otherwise("t").alias("source"))
    per = mixing.op3(docs).groupBy("target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 7 for r in per)


def test_longer_classes_have_higher_odds_and_the_plan_is_native(spark, odd):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    out = mixing.op3(docs).filter("target < 2 * source_size and size > 0")
    mean = {r["big"]: r["m"] for r in out.groupBy((F.col("size") > 300).alias("big")).agg(F.avg("copies").alias("m")).collect()}
    assert mean[True] > mean[False]
    assert "Python" not in mixing.op3(odd)._jdf.queryExecution().toString()


@pytest.mark.parametrize("text", ["a b c d", "e f g h", "i j k l"])
def test_rows_alike_are_cut_by_count(spark, text):
    """A third of a source may be one text under null or repeated ids; the words still meet the target."""
    rows = [(None, text, "a")] * 1500 + [(i, f"p{i} q{i} r{i} s{i}", "a") for i in range(1500)] \
        + [(9000 + i // 700, "x y z w", "b") for i in range(2100)] + [(20_000 + i, f"u{i} v", "c") for i in range(1400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    out = mixing.with_copies(docs, "doc_id", "text", "source")
    per = out.groupBy("source", "target").agg(F.sum(F.col("_copies") * F.col("_size")).alias("taken")).collect()
    assert len(per) == 3 and all(abs(r["taken"] - r["target"]) <= 2.01 for r in per)
    first, again = (sorted(mixing.op3(d).select(F.coalesce("doc_id", F.lit(-1)), "copies").collect()) for d in (docs, docs.repartition(3)))
    assert first == again
