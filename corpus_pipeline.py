"""The corpus pipeline: raw documents in, deduplicated, mixed and encoded documents out.

``STAGES`` lists its stages; each takes ``(spark, docs, sf_dir)`` and returns a DataFrame
that is written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.llm import bpe, line_dedup, mixing, quality, simhash
from adlens.llm.common import read_table, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go; the others stay as they are."""
    return quality.keep_good(docs)


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A line of several documents stays in the one with the smallest id. Documents keep their row,
    with a shorter text where they lose lines."""
    return line_dedup.drop_shared_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked SimHash fingerprints the document with the smallest id stays."""
    return simhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: zero, one or two rows."""
    return mixing.mix(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the bytes they decode to."""
    import public_tokenizers as P

    return bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN, ids=True, digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("simhash_near_dedup", near_copies),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

# XXH64 fingerprints and BPE merges have no SQL form; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is stored under the checkpoint folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
