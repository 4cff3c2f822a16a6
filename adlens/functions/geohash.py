"""Geohash of a (lat, lon) point as a pure Column expression (no UDF).

A geohash with ``n`` characters has ``5 n`` bits that interleave longitude and latitude
bits, longitude first. Each coordinate bit string is the index of the point's cell when
the coordinate range is cut into ``2**bits`` equal parts, which is what the classic
bisection computes. The bits are then read five at a time as base-32 characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.scalar import ColumnOrName, _col

# FIXED VALUES: the geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
# Digits of ``conv(x, 2, 32)``, in value order.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
# The alphabet by the three bits of the leading index (bits 4, 2 and 0 of the value), then the two of the other.
_DEALT_ALPHABET = "".join(
    GEOHASH_ALPHABET[(a >> 2 & 1) << 4 | (b >> 1) << 3 | (a >> 1 & 1) << 2 | (b & 1) << 1 | a & 1]
    for a in range(8) for b in range(4))


def _cell_index(v: Column, lo: float, hi: float, bits: int) -> Column:
    n = 1 << bits
    idx = F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(n))).cast("bigint")
    return F.least(F.greatest(idx, F.lit(0).cast("bigint")), F.lit(n - 1).cast("bigint"))


def _bits(precision: int) -> tuple[int, int]:
    total = 5 * precision
    return (total + 1) // 2, total // 2


def cell_indexes(lat: ColumnOrName, lon: ColumnOrName, precision: int = 6) -> tuple[Column, Column]:
    """(longitude cell index, latitude cell index) of the point at this precision."""
    lon_bits, lat_bits = _bits(precision)
    return (_cell_index(_col(lon).cast("double"), -180.0, 180.0, lon_bits),
            _cell_index(_col(lat).cast("double"), -90.0, 90.0, lat_bits))


def geohash_from_indexes(lon_idx: ColumnOrName, lat_idx: ColumnOrName, precision: int = 6) -> Column:
    """Geohash text from the two cell indexes.

    Each character is five bits that alternate between the indexes, longitude first in even places and
    latitude first in odd ones: three bits of one and two of the other are looked up in the alphabet dealt anew.
    """
    x, y = _col(lon_idx), _col(lat_idx)
    lon_left, lat_left = _bits(precision)
    chars = []
    for place in range(precision):
        lead, n_lon, n_lat = (x, 3, 2) if place % 2 == 0 else (y, 2, 3)
        other = y if lead is x else x
        lon_left, lat_left = lon_left - n_lon, lat_left - n_lat
        three, two = (lon_left, lat_left) if lead is x else (lat_left, lon_left)
        at = (F.shiftright(lead, three).bitwiseAND(F.lit(7)) * 4 + F.shiftright(other, two).bitwiseAND(F.lit(3))).cast("int")
        chars.append(F.substring(F.lit(_DEALT_ALPHABET), at + 1, F.lit(1)))
    return F.concat(*chars)


def indexes_of(cell: ColumnOrName, precision: int = 6) -> tuple[Column, Column]:
    """(longitude cell index, latitude cell index) of a geohash of this precision."""
    bits = F.lpad(F.conv(F.translate(_col(cell), GEOHASH_ALPHABET, _CONV_DIGITS), 32, 2), 5 * precision, "0")
    return (F.conv(F.regexp_replace(bits, "(.)(.?)", "$1"), 2, 10).cast("bigint"),
            F.conv(F.regexp_replace(bits, "(.)(.?)", "$2"), 2, 10).cast("bigint"))


def shifted_indexes(x: Column, y: Column, dx: Column, dy: Column, precision: int = 6) -> tuple[Column, Column]:
    """The indexes ``dx`` cells east and ``dy`` cells north. Longitude goes round at the date line; a step over
    a pole comes down on the opposite meridian."""
    lon_bits, lat_bits = _bits(precision)
    east, north = 1 << lon_bits, 1 << lat_bits
    to = y + dy
    over = (to < 0) | (to >= north)
    mirrored = F.when(to < 0, -to - 1).when(to >= north, 2 * north - 1 - to).otherwise(to)
    return F.pmod(x + dx + F.when(over, F.lit(east // 2)).otherwise(F.lit(0)), F.lit(east)), mirrored


def ring_offsets(ring: int) -> list[tuple[int, int]]:
    """Steps to the cells at Chebyshev distance ``ring``: eight times ``ring`` of them, one for 0."""
    side = range(-ring, ring + 1)
    return [(dx, dy) for dx in side for dy in side if max(abs(dx), abs(dy)) == ring]


def with_neighbours(df, cell: str, max_ring: int, precision: int = 6, out_col: str = "near"):
    """``df`` once per cell within ``max_ring`` steps of ``cell`` (itself included), as ``out_col``, with
    ``ring`` and ``steps`` (squared distance in cells). Near a pole one cell may come up on several ways."""
    offsets = [(r, dx, dy) for r in range(max_ring + 1) for dx, dy in ring_offsets(r)]
    x, y = indexes_of(cell, precision)
    table = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                                for r, dx, dy in offsets]))
    staged = df.withColumns({"__nx": x, "__ny": y}).withColumn("__o", table)
    to_x, to_y = shifted_indexes(F.col("__nx"), F.col("__ny"), F.col("__o.dx"), F.col("__o.dy"), precision)
    staged = staged.withColumns({"__tx": to_x, "__ty": to_y, "ring": F.col("__o.r"),
                                 "steps": F.col("__o.dx") * F.col("__o.dx") + F.col("__o.dy") * F.col("__o.dy")})
    return staged.withColumn(out_col, geohash_from_indexes("__tx", "__ty", precision)).drop(
        "__nx", "__ny", "__o", "__tx", "__ty")


def geohash(lat: ColumnOrName, lon: ColumnOrName, precision: int = 6) -> Column:
    """Geohash of a point as one Column expression.

    The expression reads each index once per bit; for DataFrames prefer ``with_geohash``,
    which computes the indexes in their own projection first.
    """
    lon_idx, lat_idx = cell_indexes(lat, lon, precision)
    out = geohash_from_indexes(lon_idx, lat_idx, precision)
    return F.when(_col(lat).isNotNull() & _col(lon).isNotNull(), out)


def with_geohash(df, lat: ColumnOrName, lon: ColumnOrName, out_col: str,
                 precision: int = 6, keep_if: Column | None = None):
    """``df`` plus a geohash column, computed in three projections (coordinates, cell
    indexes, characters) so no sub-expression is evaluated more than once per row."""
    staged = df.withColumns({"__gh_lat": _col(lat).cast("double"), "__gh_lon": _col(lon).cast("double")})
    lon_idx, lat_idx = cell_indexes("__gh_lat", "__gh_lon", precision)
    staged = staged.withColumns({"__gh_x": lon_idx, "__gh_y": lat_idx})
    cell = F.when(F.col("__gh_lat").isNotNull() & F.col("__gh_lon").isNotNull(),
                  geohash_from_indexes("__gh_x", "__gh_y", precision))
    if keep_if is not None:
        cell = F.when(keep_if, cell)
    return staged.withColumn(out_col, cell).drop("__gh_lat", "__gh_lon", "__gh_x", "__gh_y")


def geohash6(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    return geohash(lat, lon, 6)
