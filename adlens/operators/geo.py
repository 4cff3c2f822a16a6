"""Business areas by geohash cell.

The platform looked up a cache keyed by 6-character geohash and called a geocoder per row on
a miss. Here the cache is a dimension table ``(geohash6, business_areas)`` built from stored
geocoder responses, the lookup is an equi-join, and the cache misses are a first-class
output: one row per distinct missing cell, with a deterministic representative point, that an
outside geocoding batch can fill.

Scale: the dimension grows with the covered area (tens of millions of cells at most), so it
is broadcast only behind a size check; otherwise it is a shuffle join on the cell, where
AQE splits a hot cell (a city centre) across tasks. The worklist is a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.geocode import business_areas_from_parsed, parse_response
from adlens.functions.geohash import with_geohash, with_neighbours
from adlens.functions.scalar import in_geo_box, is_blank, lenient_double
from adlens.operators.dimensions import join_dimension

CELL = "geohash6"


def with_cell(df: DataFrame, box_filter: bool = True, out_col: str = CELL) -> DataFrame:
    """Add the geohash cell of the row's point (null when outside the box, if filtered)."""
    staged = df.withColumns({"__lat_d": lenient_double("lat"), "__lon_d": lenient_double("long")})
    box = None
    if box_filter:
        b = S.GEO_BOX
        box = (F.col("__lon_d").between(b["long_min"], b["long_max"])
               & F.col("__lat_d").between(b["lat_min"], b["lat_max"]))
    out = with_geohash(staged, "__lat_d", "__lon_d", out_col, S.GEOHASH_CHARS, box)
    return out.drop("__lat_d", "__lon_d")


def in_box_cells(df: DataFrame, out_col: str = CELL) -> DataFrame:
    """Rows inside the box with their cell. The filter is the small box predicate, applied
    before the cell is computed, so the optimizer pushes a cheap condition to the scan."""
    return with_cell(df.filter(in_geo_box("long", "lat")), False, out_col)


def geo_dimension(responses: DataFrame, cell_col: str = CELL,
                  response_col: str = "response") -> DataFrame:
    """Cache table from stored responses: only non-empty results are cached."""
    parsed = (responses.select(F.col(cell_col).alias(CELL), parse_response(response_col).alias("__p"))
                       .select(CELL, business_areas_from_parsed(F.col("__p")).alias("business_areas")))
    # Filter after the de-duplication so the predicate is not pushed below it.
    return (parsed.groupBy(CELL).agg(F.max("business_areas").alias("business_areas"))
                  .filter(F.col("business_areas") != ""))


def lookup_business(df: DataFrame, geo_dim: DataFrame, box_filter: bool = True,
                    **join_kw) -> DataFrame:
    """Add ``business_areas`` (null for points outside the box or cells not cached)."""
    cells = with_cell(df, box_filter)
    dim = geo_dim.select(F.col(CELL).alias("__cell"), "business_areas")
    out = join_dimension(cells, dim, F.col(CELL) == F.col("__cell"), "left", **join_kw)
    return out.drop("__cell")


def nearest_cached(cells: DataFrame, geo_dim: DataFrame, max_ring: int = 2, **join_kw) -> DataFrame:
    """``geohash6, near, ring, business_areas`` for each distinct cell of ``cells`` that has a cached cell
    within ``max_ring`` steps: itself (ring 0), or the one of the nearest ring, of several the one fewest steps away,
    then the smallest.

    Only distinct cells are looked at, and only those that are not cached look around: at most
    ``(2 max_ring + 1) ** 2`` keys each, in one join.
    """
    own = join_dimension(cells.select(CELL).filter(F.col(CELL).isNotNull()).distinct(),
                         geo_dim.select(F.col(CELL).alias("near"), "business_areas"), F.col(CELL) == F.col("near"), "left", **join_kw)
    held = own.filter(F.col("near").isNotNull()).select(CELL, "near", F.lit(0).alias("ring"), "business_areas")
    around = with_neighbours(own.filter(F.col("near").isNull()).select(CELL), CELL, max_ring)
    met = join_dimension(around.filter("ring > 0"), geo_dim.select(F.col(CELL).alias("near"), "business_areas"), "near", "inner", **join_kw)
    best = met.groupBy(CELL).agg(F.min(F.struct("ring", "steps", "near", "business_areas")).alias("b"))
    return held.unionByName(best.select(CELL, "b.near", "b.ring", "b.business_areas"))


def lookup_business_near(df: DataFrame, geo_dim: DataFrame, max_ring: int = 2, **join_kw) -> DataFrame:
    """J3 with a fallback: as ``lookup_business`` for points inside the box, but a cell that is not cached takes
    the areas of the nearest cached one within ``max_ring`` steps. Adds ``near``, ``ring`` and ``business_areas``."""
    cells = with_cell(df)
    near = nearest_cached(cells, geo_dim, max_ring, **join_kw).withColumnRenamed(CELL, "__cell")
    return join_dimension(cells, near, F.col(CELL) == F.col("__cell"), "left", **join_kw).drop("__cell")


def missing_cells(df: DataFrame, geo_dim: DataFrame, **join_kw) -> DataFrame:
    """Distinct in-box cells absent from the cache, each with one representative point.

    The point is one that a row has: the smallest longitude seen in the cell and, of those,
    the smallest latitude.
    """
    pts = in_box_cells(df).select(CELL, lenient_double("long").alias("long"),
                                  lenient_double("lat").alias("lat"))
    per_cell = pts.groupBy(CELL).agg(F.min(F.struct("long", "lat")).alias("p")).select(CELL, "p.long", "p.lat")
    return join_dimension(per_cell, geo_dim.select(CELL), CELL, "left_anti", **join_kw)


def upsert_cells(dim: DataFrame, responses: DataFrame, cell_col: str = CELL, response_col: str = "response",
                 order_col: str | None = None) -> DataFrame:
    """J4, closing the loop: the cache ``dim`` with the newly fetched ``responses`` in it.

    A cell with a new non-empty result gets that result, of several the one with the largest
    ``order_col`` (without one, the largest text); a response without any result changes nothing, as
    only results are cached. The caller stores the outcome as the next dimension.
    """
    if order_col is None:
        new = geo_dimension(responses, cell_col, response_col)
    else:
        parsed = (responses.select(F.col(cell_col).alias(CELL), F.col(order_col).alias("__o"),
                                   parse_response(response_col).alias("__p"))
                           .select(CELL, "__o", business_areas_from_parsed(F.col("__p")).alias("business_areas")))
        new = (parsed.filter(F.col("business_areas") != "").groupBy(CELL)
                     .agg(F.max(F.struct("__o", "business_areas")).alias("b")).select(CELL, "b.business_areas"))
    return dim.select(CELL, "business_areas").join(new.select(CELL), CELL, "left_anti").unionByName(new)


def business_names(business: F.Column) -> F.Column:
    """Names of one cached value, split like Java ``split(",")`` (trailing empties dropped)."""
    stripped = F.regexp_replace(business, ",+$", "")
    return F.when(is_blank(business) | (stripped == ""),
                  F.array().cast("array<string>")).otherwise(F.split(stripped, ",", -1))
