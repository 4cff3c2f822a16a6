"""Value perturbation of raw log lines for building test inputs.

Each rule draws random values once per (line, column), exactly like the original tool,
but the draws are seeded and replayable: draw ``k`` of a column is hex digits
``8 (k % 4) + 1 .. + 8`` of ``md5(md5(line) + ':' + column + ':' + seed + ':' + k div 4)``; the
line itself is digested once. The same numbers can be produced by any engine with md5, and a
re-run (or a retried task) gives the same output.

Substring rules replace every occurrence of a character by one drawn value. The original
tool's ``replace("", x)`` inserts ``x`` into every gap of a string; here such rules fill
only empty cells (documented deviation). No line is lost: a line of fewer than 85 fields keeps
its number of fields, a longer one is cut to 85.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens import schema as S

# FIXED VALUES: the value pools of the perturbation tool, in their original order.
DIGITS = [1, 3, 2, 4, 5, 6, 7, 8, 9]
LETTERS = ["a", "b", "c", "d", "5", "e", "t", "s", "h", "l", "z", "b", "c", "m", "p", "o", "q", "w"]
ONE_TO_THREE = [1, 2, 3]
ZERO_ONE = [0, 1]
TWO_THREE = [2, 3]

# FIXED VALUES: substring rules (column position -> character replaced, pool, draws).
SUBSTRING_RULES = {
    2: ("0", "zero_one", 1), 8: ("1", "one_to_three", 1), 30: ("0", "zero_one", 1),
    31: ("0", "zero_one", 1), 35: ("2", "one_to_three", 1), 39: ("0", "zero_one", 1),
    40: ("0", "digits", 4), 42: ("0", "zero_one", 1), 78: ("0", "digits", 4),
}
# FIXED VALUES: empty-cell fills of longitude, latitude and the five plain device ids, as text and
# one pool per drawn character.
LONG_COLUMN, LAT_COLUMN = 22, 23
ID_FILL_COLUMNS = [46, 47, 48, 49, 50]
LONG_FILL = ["11", "digits", "."] + ["digits"] * 9
LAT_FILL = ["two_three", "digits", "."] + ["digits"] * 9
ID_FILL = ["index9", "letters", "letters", "letters", "index9", "letters",
           "index9", "letters", "index9", "letters"]

POOLS = {
    "digits": [str(d) for d in DIGITS],
    "letters": LETTERS,
    "one_to_three": [str(d) for d in ONE_TO_THREE],
    "zero_one": [str(d) for d in ZERO_ONE],
    "two_three": [str(d) for d in TWO_THREE],
    "index9": [str(d) for d in range(len(DIGITS))],  # Random.nextInt(9)
}


DRAWS_PER_HASH = 4  # an md5 hex digest holds four 8-hex-digit draws


def _hash_col(col: int, block: int) -> str:
    return f"__h{col}_{block}"


FILLS = {LONG_COLUMN: LONG_FILL, LAT_COLUMN: LAT_FILL, **dict.fromkeys(ID_FILL_COLUMNS, ID_FILL)}


def _n_draws(col: int) -> int:
    return SUBSTRING_RULES[col][2] if col in SUBSTRING_RULES else sum(part in POOLS for part in FILLS[col])


PERTURBED = sorted({*SUBSTRING_RULES, *FILLS})


def hash_columns(digest: Column, seed: int) -> list[Column]:
    """md5 of ``digest:col:seed:block`` for every block of draws a column needs."""
    out = []
    for col in PERTURBED:
        for block in range((_n_draws(col) + DRAWS_PER_HASH - 1) // DRAWS_PER_HASH):
            key = F.concat_ws(":", digest, F.lit(str(col)), F.lit(str(seed)), F.lit(str(block)))
            out.append(F.md5(key).alias(_hash_col(col, block)))
    return out


def draw(col: int, k: int) -> Column:
    """Draw ``k`` of column ``col``: a non-negative 32-bit integer (needs ``hash_columns``)."""
    h = F.col(_hash_col(col, k // DRAWS_PER_HASH))
    return F.conv(F.substring(h, (k % DRAWS_PER_HASH) * 8 + 1, 8), 16, 10).cast("bigint")


def pick(pool: str, col: int, k: int) -> Column:
    values = "".join(POOLS[pool])  # every pool value is one character
    idx = (F.pmod(draw(col, k), F.lit(len(values))) + 1).cast("int")
    return F.lit(values).substr(idx, F.lit(1))


def _drawn(parts: list[str], col: int) -> Column:
    """Literal parts as they are, a drawn character for each pool name."""
    out, k = [], 0
    for part in parts:
        out.append(pick(part, col, k) if part in POOLS else F.lit(part))
        k += part in POOLS
    return F.concat(*out)


def perturb_fields(fields: Column) -> list[Column]:
    """The first 85 fields after perturbation; null where the line has no such field."""
    out = []
    for i in range(S.N_LOG_FIELDS):
        v = F.get(fields, F.lit(i))
        if i in SUBSTRING_RULES:
            ch, pool, n = SUBSTRING_RULES[i]
            v = F.replace(v, F.lit(ch), _drawn([pool] * n, i))
        elif i in FILLS:
            v = F.when(v == "", _drawn(FILLS[i], i)).otherwise(v)
        out.append(v)
    return out


def perturb_lines(lines: DataFrame, seed: int = 0, value_col: str = "value",
                  keep: list[str] | None = None) -> DataFrame:
    """Every input line, perturbed; a null line stays null."""
    keep = keep or []
    line = F.col(value_col)
    digested = lines.select(*keep, F.split(line, ",", -1).alias("__f"), F.md5(line).alias("__d"))
    hashed = digested.select(*keep, "__f", *hash_columns(F.col("__d"), seed))
    # concat_ws skips nulls, which here are the fields that a short line does not have.
    text = F.concat_ws(",", *perturb_fields(F.col("__f")))
    return hashed.select(*keep, F.when(F.col("__f").isNotNull(), text).alias(value_col))
