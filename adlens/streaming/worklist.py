"""J4 as a stream: geohash cells to geocode, asked for once while logs arrive.

The platform called a geocoder from every row whose cell was not cached, so a cell was asked for as often as
it came up until the answer was stored. Here a stateful stream remembers the cells it has seen: a cell goes to the
worklist when it comes up first and is silent for ``ask_again`` after that. Then its state expires, so the
state holds the cells of that span only, and a cell that comes up again is asked for again - unless
its answer is in the dimension by then, which is read anew for every batch.

Time is the arrival of a batch, which never runs backwards, so no row is ever too late and no cell is lost. The
worklist is one folder per batch, replaced if a batch runs again after a failure: each cell is written exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adlens.functions.scalar import lenient_double
from adlens.operators.dimensions import join_dimension
from adlens.operators.geo import CELL, in_box_cells
from adlens.streaming.incremental import start

WORKLIST = f"{CELL} string, long double, lat double"


def first_seen_cells(log_stream: DataFrame, ask_again: str = "7 days") -> DataFrame:
    """``geohash6, long, lat``: cells inside the box that did not come up within ``ask_again``, with the point of
    one of their rows. State: one row per cell, keyed by cell."""
    points = in_box_cells(log_stream.select("long", "lat")).select(
        CELL, lenient_double("long").alias("long"), lenient_double("lat").alias("lat"),
        F.current_timestamp().alias("arrived"))
    return points.withWatermark("arrived", ask_again).dropDuplicatesWithinWatermark([CELL]).select(CELL, "long", "lat")


def start_worklist(log_stream: DataFrame, read_dim: Callable[[SparkSession], DataFrame], path: str, checkpoint: str,
                   ask_again: str = "7 days", available_now: bool = True, **join_kw) -> StreamingQuery:
    """Write the cells to ask for under ``path``; ``read_dim`` gives the cache table as it is at that time."""
    def write(batch: DataFrame, number: int) -> None:
        missing = join_dimension(batch, read_dim(batch.sparkSession).select(CELL), CELL, "left_anti", **join_kw)
        missing.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return start(first_seen_cells(log_stream, ask_again), checkpoint, output_mode="append", available_now=available_now,
                 foreach_batch=write)


def read_worklist(spark: SparkSession, path: str) -> DataFrame:
    """``geohash6, long, lat, batch`` of all batches that were written."""
    return spark.read.schema(f"{WORKLIST}, batch bigint").parquet(path)
