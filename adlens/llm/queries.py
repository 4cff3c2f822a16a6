"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import (ann, bpe, jaccard, line_dedup, lm, mixing, quality, runs, sharding, simhash,
                        spelling, token_counts, token_files)
from adlens.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op8_quality_rules", quality.OP8_SQL)
def op8_quality_rules(spark, sf_dir):
    return quality.op8(read_table(spark, sf_dir, "documents"))


@register("op4_byte_bpe")
def op4_byte_bpe(spark, sf_dir):
    import public_tokenizers as P

    return bpe.op4(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@register("op3_source_mix", mixing.OP3_SQL)
def op3_source_mix(spark, sf_dir):
    return mixing.op3(read_table(spark, sf_dir, "documents"))


@register("op9_byte_shards")
def op9_byte_shards(spark, sf_dir):
    return sharding.op9(read_table(spark, sf_dir, "documents"))


@register("op5_simhash")
def op5_simhash(spark, sf_dir):
    return simhash.op5(read_table(spark, sf_dir, "documents"))


@register("op10_line_dedup", line_dedup.OP10_SQL)
def op10_line_dedup(spark, sf_dir):
    return line_dedup.op10(read_table(spark, sf_dir, "documents"))


@register("op6_token_files")
def op6_token_files(spark, sf_dir):
    import public_tokenizers as P

    return token_files.op6(spark, read_table(spark, sf_dir, "documents"), P.path("word_bpe_49k.json"))


@register("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    import public_tokenizers as P

    return token_counts.op7(read_table(spark, sf_dir, "documents"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


@register("op1_log_bilinear")
def op1_log_bilinear(spark, sf_dir):
    return lm.op1(read_table(spark, sf_dir, "documents"))


@register("op2_adaptive_scan")
def op2_adaptive_scan(spark, sf_dir):
    return ann.op2(read_table(spark, sf_dir, "embeddings"))


@register("op11_periodic_runs")
def op11_periodic_runs(spark, sf_dir):
    return runs.op11(read_table(spark, sf_dir, "documents"))


@register("op13_spelling_variants")
def op13_spelling_variants(spark, sf_dir):
    return spelling.op13(read_table(spark, sf_dir, "documents"))


@register("op12_jaccard_join")
def op12_jaccard_join(spark, sf_dir):
    return jaccard.op12(read_table(spark, sf_dir, "documents"))
