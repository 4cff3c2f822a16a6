"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.session import scratch_path

# A word is a run of characters outside this set: space and \x09-\x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """``columns`` (new name -> exact old name) of ``df`` and nothing else.

    Columns are found by position, so extra columns whose names differ only in case, or
    clash with an operator's own column names, are harmless. Of several columns with the
    same exact name the first is taken.
    """
    names = df.columns
    frame = df.toDF(*[f"_{i}" for i in range(len(names))])
    return frame.select(*[F.col(f"_{names.index(old)}").alias(new) for new, old in columns.items()])


class Positional:
    """``df`` with its columns renamed by position, so that helper columns can be added
    beside any extra columns, and ``restore`` gives the original names back."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.keys = [f"_{i}" for i in range(len(self.names))]
        self.frame = df.toDF(*self.keys)

    def __getitem__(self, name: str) -> str:
        return self.keys[self.names.index(name)]

    def restore(self, frame: DataFrame) -> DataFrame:
        return frame.select(*self.keys).toDF(*self.names)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(text: Column) -> Column:
    """The words of a non-null text; an empty array for none."""
    bare = strip_spaces(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN, -1))


def stored(df: DataFrame, name: str, **options: int) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back: it cuts the
    lineage like checkpoint(), survives lost executors and keeps column pruning. ``options`` go to the writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
