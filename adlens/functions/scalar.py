"""Column-expression helpers (no UDFs): blank test, lenient casts, labels, geo box.

Every function takes and returns ``pyspark.sql.Column`` so it stays inside
whole-stage codegen and composes with any DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens import schema as S

ColumnOrName = Column | str

# Java whitespace (Character.isWhitespace) as a regex class: the blank test of the SQL functions.
_BLANK_RE = r"\A\p{javaWhitespace}*\z"
# Any other character: the blank test of columns, which mostly ends at the first one.
_VISIBLE_RE = r"\P{javaWhitespace}"
# Java Integer.parseInt accepts an optional sign and ASCII digits, nothing else.
_JAVA_INT_RE = r"\A[+-]?[0-9]+\z"
# Spark's string->double cast also accepts these case-insensitive spellings; Java does not.
_SPARK_ONLY_SPECIALS_RE = r"(?i)\A[\x00-\x20]*[+-]?(inf|infinity|nan)[\x00-\x20]*\z"
_JAVA_SPECIALS_RE = r"\A[\x00-\x20]*([+-]?Infinity|[+-]?NaN)[\x00-\x20]*\z"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnOrName) -> Column:
    """True for null, empty, or only Java whitespace (tab, newline, U+3000, ...)."""
    c = _col(c)
    return c.isNull() | ~c.rlike(_VISIBLE_RE)


def not_blank(c: ColumnOrName) -> Column:
    c = _col(c)
    return c.isNotNull() & c.rlike(_VISIBLE_RE)


def lenient_int(c: ColumnOrName) -> Column:
    """Java ``toInt`` with every failure mapped to 0 (spaces, decimals, overflow)."""
    c = _col(c)
    return F.coalesce(F.when(c.rlike(_JAVA_INT_RE), c.try_cast("int")), F.lit(0))


def lenient_double(c: ColumnOrName) -> Column:
    """Java ``toDouble`` with every failure mapped to 0.0."""
    c = _col(c)
    # All special spellings hold an n, which spares numbers the regexes.
    lettered = F.contains(c, F.lit("n")) | F.contains(c, F.lit("N"))
    spark_only = lettered & c.rlike(_SPARK_ONLY_SPECIALS_RE) & ~c.rlike(_JAVA_SPECIALS_RE)
    return F.coalesce(F.when(~spark_only, c.try_cast("double")), F.lit(0.0).cast("double"))


def int_or_zero(c: ColumnOrName) -> Column:
    """A null int read as 0, like unboxing a missing Int."""
    return F.coalesce(_col(c), F.lit(0))


def code_label(c: ColumnOrName, labels: dict, default: str) -> Column:
    """Map codes to labels with a default for anything else (null included)."""
    c = _col(c)
    out = None
    for code, label in labels.items():
        out = F.when(c == F.lit(code), F.lit(label)) if out is None else out.when(c == F.lit(code), F.lit(label))
    return out.otherwise(F.lit(default))


def os_label(c: ColumnOrName = "client") -> Column:
    return code_label(c, S.OS_LABELS, S.OTHER)


def device_label(c: ColumnOrName = "devicetype") -> Column:
    return code_label(c, S.DEVICE_LABELS, S.OTHER)


def normalise_unknown(c: ColumnOrName) -> Column:
    """Rename the 'unknown' label to 'other'; empty and null stay as they are."""
    c = _col(c)
    return F.when(c == F.lit(S.UNKNOWN), F.lit(S.OTHER)).otherwise(c)


def in_geo_box(long: ColumnOrName = "long", lat: ColumnOrName = "lat") -> Column:
    """Inclusive China box on leniently parsed coordinates (unparsable -> 0.0 -> outside)."""
    lo, la = lenient_double(long), lenient_double(lat)
    b = S.GEO_BOX
    return lo.between(b["long_min"], b["long_max"]) & la.between(b["lat_min"], b["lat_max"])


def utf16_length(c: ColumnOrName) -> Column:
    """String length in UTF-16 code units (Java ``String.length``)."""
    return F.floor(F.octet_length(F.encode(_col(c), "UTF-16BE")) / 2).cast("int")


def utf16_length_between(c: ColumnOrName, least: int, most: int) -> Column:
    """``utf16_length`` within the bounds. It lies between the number of characters and that of UTF-8 bytes,
    and is at most twice the former, so that few texts have to be encoded anew."""
    c = _col(c)
    chars, octets = F.char_length(c), F.octet_length(c)
    surely = (chars >= least) & ((chars * 2 <= most) | (chars == octets))
    return (chars <= most) & (octets >= least) & (surely | utf16_length(c).between(least, most))


def prefixed(prefix: str, c: ColumnOrName) -> Column:
    """``prefix + value`` with Java string-concat semantics (null renders as 'null')."""
    return F.concat(F.lit(prefix), F.coalesce(_col(c).cast("string"), F.lit("null")))


def md5_bucket(c: ColumnOrName, n: ColumnOrName) -> Column:
    """Deterministic bucket in [0, n) from the first 32 bits of md5(value).

    Chosen because the same number can be computed by any SQL engine that has md5.
    """
    h = F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, _col(n).cast("bigint"))
