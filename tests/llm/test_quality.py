"""Quality rules: brute-force measurements, policies and ablations."""

import random
import re
from collections import Counter

from llm_fixtures import SF, odd_rows

from adlens.llm import quality
from adlens.llm.common import read_table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(c) for c in quality.SYMBOLS), len(lines) - len(set(lines)), len(covered))


def test_measures_match_brute_force_on_odd_rows(spark, odd):
    got = sorted(((r.doc_id is None, r.doc_id or 0, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
                  for r in quality.op8(odd).collect()))
    want = sorted((r[0] is None, r[0] or 0, brute(r[1])) for r in odd_rows())
    assert got == want


def test_verdicts(odd):
    got = {r.doc_id: r for r in quality.op8(odd).collect()}
    assert got[5].kept and not got[5].base_failed
    assert got[10].base_failed and got[11].base_failed and got[3].base_failed


def test_ledger_answers_policies_and_ablations_without_texts(spark):
    ledger = quality.measure(read_table(spark, SF, "documents")).cache()
    rows = ledger.collect()
    mask = quality.mask_of(quality.POLICIES["v3"])
    by_rule = {r["rule"]: r for r in quality.ablation(ledger, "v3").collect()}
    for rule in quality.RULES:
        bit = rule.mask
        if not bit & mask:
            assert rule.name not in by_rule
            continue
        assert by_rule[rule.name]["failing"] == sum(bool(r.fail_bits & bit) for r in rows)
        assert by_rule[rule.name]["only_this"] == sum(r.fail_bits & mask == bit for r in rows)
        assert by_rule[rule.name]["kept_without"] == sum(not r.fail_bits & mask & ~bit for r in rows)
    kept = {v: quality.apply_policy(ledger, v).filter("kept").count() for v in quality.POLICIES}
    assert kept["v1"] >= kept["v2"] >= kept["v4"] >= kept["v3"] > 0


def test_texts_without_word_spaces_are_kept(spark):
    clause = lambda i, first, n: "".join(chr(first + x) for x in random.Random(i).choices(range(n), k=28))
    texts = [" ".join(clause(i, first, n) for i in range(80)) for first, n in ((0x4E00, 5000), (0x0E01, 45), (0x3041, 80))]
    texts.append(" ".join(f"{i:030d}" for i in range(80)))  # long words of a spaced script stay rejected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in quality.op8(docs).collect()}
    assert [rows[i].kept for i in range(4)] == [True, True, True, False] and not any(r.base_failed for r in rows.values())
    assert [rows[i].unspaced_chars for i in range(4)] == [2240, 2240, 2240, 0]
    assert not quality.apply_policy(quality.measure(docs), "v3").filter("kept").count()


def test_clean_labelled_documents_stay(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    judged = quality.op8(docs).join(labels, "doc_id").filter("not base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in judged)


def test_filter_keeps_columns_and_clashes(odd, empty):
    out = quality.keep_good(odd)
    assert out.columns == odd.columns and {r.doc_id for r in out.collect()} == {5, 6}
    assert quality.op8(empty).count() == 0 and quality.keep_good(empty).count() == 0


def test_texts_are_measured_without_python_or_shuffle(odd):
    plan = quality.measure(odd)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_policies_and_ablation_read_the_stored_ledger(spark, odd):
    result = quality.op8(odd)
    assert "Python" not in result._jdf.queryExecution().toString()
    assert result.inputFiles() and all("/quality-ledger" in f for f in result.inputFiles())
    docs = read_table(spark, SF, "documents")
    rows = quality.op8(docs).collect()
    mask = quality.mask_of(quality.POLICIES[quality.CURRENT])
    for r in rows:
        bits = r.fail_bits & mask
        rule = next((x for x in quality.RULES if x.mask == bits), None)
        assert r.sole_rule == (rule.name if rule else "")
        assert r.kept_before == (r.fail_bits & quality.mask_of(quality.POLICIES["v3"]) == 0)
        if rule:
            assert r.sole_rule_failing == sum(bool(x.fail_bits & rule.mask) for x in rows)
            assert r.kept_without == sum(not x.fail_bits & mask & ~rule.mask for x in rows)
        else:
            assert r.sole_rule_failing == r.kept_without == 0
