"""Small dimension inputs: the app dictionary (S5) and the stop-word list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Java regex \s: one whitespace character separates dictionary fields.
_WS = r"\s"


def parse_app_dict(lines: DataFrame, keep_trailing: bool = True, value_col: str = "value",
                   order_col: str = "line_no") -> DataFrame:
    """(appid, appname_dict) from whitespace-separated lines: key = field 4, name = field 1.

    ``keep_trailing=True`` splits like ``split("\\s", -1)`` (report jobs); ``False`` like
    ``split("\\s")``, which drops trailing empty fields first (tag jobs), so a line whose
    fifth field is empty only passes the first variant. Lines with under five fields are
    ignored and the last line for a key wins (largest ``order_col``).
    """
    text = F.col(value_col)
    if not keep_trailing:
        text = F.regexp_replace(text, r"\s+$", "")
    fields = F.split(text, _WS, -1)
    parsed = (
        lines.select(fields.alias("f"), F.col(order_col).alias("__ord"))
        .filter(F.size("f") >= 5)
        .select(F.col("f")[4].alias("appid"), F.col("f")[1].alias("name"), "__ord")
    )
    return parsed.groupBy("appid").agg(F.max_by("name", "__ord").alias("appname_dict"))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their order in the input: file name, split of the file, place in it.

    Spark packs files into tasks by size, so a running row number alone is not file order.
    """
    return spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("line_no"))


def load_app_dict(spark: SparkSession, path: str, keep_trailing: bool = True) -> DataFrame:
    return parse_app_dict(read_text_lines(spark, path), keep_trailing)


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One whole, untrimmed line = one stop word."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def stopwords_frame(spark: SparkSession, words: list[str]) -> DataFrame:
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], "word string")
