"""Neighbour cells over borders, the date line and the poles; the nearest cached cell against brute force."""

import random

from pyspark.sql import functions as F

from adlens.functions.geohash import geohash, indexes_of, with_geohash, with_neighbours
from adlens.operators import geo as G


def test_indexes_come_back(spark):
    rng = random.Random(1)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]
    frame = spark.createDataFrame(points, "lat double, lon double")
    for precision in (5, 6):
        x, y = indexes_of("g", precision)
        out = with_geohash(frame, "lat", "lon", "g", precision).select("*", x.alias("x"), y.alias("y")).collect()
        east, north = 1 << (5 * precision + 1) // 2, 1 << 5 * precision // 2
        assert all(r.x == min(int((r.lon + 180) / 360 * east), east - 1) and
                   r.y == min(int((r.lat + 90) / 180 * north), north - 1) for r in out)


def _around(spark, lat, lon, ring=1):
    frame = spark.createDataFrame([(lat, lon)], "lat double, lon double").select(geohash("lat", "lon").alias("c"))
    x, y = indexes_of("near")
    rows = with_neighbours(frame, "c", ring).select("ring", "steps", x.alias("x"), y.alias("y")).collect()
    return {(r.x, r.y): (r.ring, r.steps) for r in rows}


def test_borders_date_line_and_poles(spark):
    n = 1 << 15
    assert set(_around(spark, 0.0, 0.0)) == {(x % n, y) for x in range(n // 2 - 1, n // 2 + 2) for y in range(n // 2 - 1, n // 2 + 2)}
    assert {x for x, _ in _around(spark, 10.0, 179.9999)} == {n - 2, n - 1, 0}
    assert {x for x, _ in _around(spark, 10.0, -180.0)} == {n - 1, 0, 1}
    top = _around(spark, 90.0, 0.0)
    assert {y for _, y in top} == {n - 1, n - 2} and (0, n - 1) in top and (n // 2, n - 1) in top
    bottom = _around(spark, -90.0, -180.0)
    assert {y for _, y in bottom} == {0, 1} and (n // 2, 0) in bottom
    assert len(_around(spark, 10.0, 20.0, 3)) == 49


def test_nearest_cached_cell(spark):
    rng = random.Random(5)
    at = lambda k: [(30 + rng.randrange(60) * 0.0055 + 0.002, 100 + rng.randrange(60) * 0.011 + 0.004) for _ in range(k)]
    frame = lambda p: with_geohash(spark.createDataFrame(p, "lat double, lon double"), "lat", "lon", G.CELL)
    x, y = indexes_of(G.CELL)
    dim = frame(at(60)).select(G.CELL).distinct().withColumn("business_areas", F.concat(F.lit("A"), G.CELL))
    asked = frame(at(400)).select(G.CELL).unionByName(dim.select(G.CELL).limit(5)).unionByName(
        spark.createDataFrame([(None,)], f"{G.CELL} string"))
    held = [(r[0], r.x, r.y) for r in dim.select(G.CELL, x.alias("x"), y.alias("y")).collect()]
    want = {}
    for r in asked.filter(F.col(G.CELL).isNotNull()).select(G.CELL, x.alias("x"), y.alias("y")).collect():
        near = min((max(abs(r.x - a), abs(r.y - b)), (r.x - a) ** 2 + (r.y - b) ** 2, c) for c, a, b in held)
        if near[0] <= 3:
            want[r[0]] = (near[2], near[0], "A" + near[2])
    got = {r[0]: tuple(r)[1:] for r in G.nearest_cached(asked, dim, 3).collect()}
    assert got == want and {r for _, r, _ in want.values()} == {0, 1, 2, 3}
    points = spark.createDataFrame([("100.004", "30.002"), ("0", "0")], "long string, lat string")
    assert G.lookup_business_near(points, dim, 3).count() == 2
    assert G.nearest_cached(asked.limit(0), dim, 3).isEmpty() and G.nearest_cached(asked, dim.limit(0), 3).isEmpty()
