"""Business-area names from a stored reverse-geocoder JSON response.

Rules: ``status`` read as an integer, 0 or missing -> ''; a missing ``regeocode``,
``addressComponent`` or ``businessAreas`` -> ''; only JSON objects in the array count, each
contributes its ``name`` (a missing name prints as ``null``); names are joined with ','.

The array is read as ``array<string>`` on purpose: then each element keeps its raw JSON text
and a non-object element (``[]``, ``"x"``) cannot null out the whole array, which an
``array<struct>`` schema would do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.scalar import ColumnOrName, _col, lenient_int

RESPONSE_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("regeocode", T.StructType([
        T.StructField("addressComponent", T.StructType([
            T.StructField("businessAreas", T.ArrayType(T.StringType())),
        ])),
    ])),
])


def parse_response(response: ColumnOrName) -> Column:
    return F.from_json(_col(response), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})


def parse_business_areas(response: ColumnOrName) -> Column:
    return business_areas_from_parsed(parse_response(response))


def business_areas_from_parsed(parsed: Column) -> Column:
    """As ``parse_business_areas`` on a response already parsed with ``parse_response``."""
    status = lenient_int(parsed["status"])
    areas = parsed["regeocode"]["addressComponent"]["businessAreas"]
    objects = F.filter(areas, lambda x: x.startswith("{"))
    names = F.transform(objects, lambda x: F.coalesce(F.get_json_object(x, "$.name"), F.lit("null")))
    return F.when((status == 0) | areas.isNull(), F.lit("")).otherwise(F.array_join(names, ","))
