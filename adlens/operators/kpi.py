"""The nine-metric KPI vector and the report operator.

``kpi_report(df, dims)`` is one hash aggregation: Catalyst plans a partial aggregate before
the shuffle and a final one after it, so a hot dimension value (one province holding a
third of the rows) costs one partial row per map task, never a skewed reducer. Only the
dimension and the nine input columns are read from the scan.

Money below ``EXACT_BELOW`` is summed as an exact decimal and divided by 1000 once at the end, so
the result does not depend on the order in which partial sums meet (a float sum does). Dirty
amounts - NaN, infinite or huge ones - are summed as doubles beside it and added: they show in
the total as they do in double arithmetic, and no amount overflows the decimal. Amounts under 1e-10
count as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Exact decimal used for the money sums: 28 integer digits, 10 fractional digits.
MONEY_DECIMAL = "decimal(38,10)"
# Ten trillion such amounts fit the decimal's 28 integer digits. NaN is above every bound.
EXACT_BELOW = 1e15
MONEY = {"win_price_k": "winprice", "ad_payment_k": "adpayment"}


def _money_parts(cond: Column, c: str) -> tuple[Column, Column]:
    """The exact sum of the clean amounts and the double sum of the others."""
    amount = F.coalesce(F.col(c), F.lit(0.0))
    clean = F.abs(amount) < EXACT_BELOW
    return (F.coalesce(F.sum(F.when(cond & clean, amount.cast(MONEY_DECIMAL))), F.lit(0).cast(MONEY_DECIMAL)),
            F.coalesce(F.sum(F.when(cond & ~clean, amount)), F.lit(0.0)))


def _thousands(exact: Column, rest: Column) -> Column:
    return (exact.cast("double") + rest) / F.lit(1000.0)


def kpi_conditions() -> dict[str, Column]:
    rm, pn = F.col("requestmode"), F.col("processnode")
    eff, bill, bid = F.col("iseffective"), F.col("isbilling"), F.col("isbid")
    bids = (eff == 1) & (bill == 1) & (bid == 1)
    return {
        "raw_req": (rm == 1) & pn.isin(1, 2, 3),
        "valid_req": (rm == 1) & pn.isin(2, 3),
        "ad_req": (rm == 1) & (pn == 3),
        "shows": (rm == 2) & (eff == 1),
        "clicks": (rm == 3) & (eff == 1),
        "bids": bids,
        "wins": bids & (F.col("iswin") == 1) & (F.col("adorderid") != 0),
    }


def kpi_columns() -> list[Column]:
    """Nine aggregate Columns: seven BIGINT counts and two DOUBLE money totals."""
    cond = kpi_conditions()
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in cond.items()]
    return counts + [_thousands(*_money_parts(cond["wins"], c)).alias(n) for n, c in MONEY.items()]


def kpi_parts(df: DataFrame, dims: list[Column | str]) -> DataFrame:
    """The vector by ``dims`` in a form that ``kpi_from_parts`` sums up further."""
    cond = kpi_conditions()
    parts = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in cond.items()]
    for name, c in MONEY.items():
        exact, rest = _money_parts(cond["wins"], c)
        parts += [exact.alias(f"{name}_exact"), rest.alias(f"{name}_rest")]
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("ct"), *parts)


def kpi_from_parts(parts: DataFrame, dims: list[Column | str]) -> DataFrame:
    """The KPI vector by ``dims`` from the finer groups of ``kpi_parts``."""
    counts = [F.sum(n).alias(n) for n in kpi_conditions()]
    money = [_thousands(F.sum(f"{n}_exact").cast(MONEY_DECIMAL), F.sum(f"{n}_rest")).alias(n) for n in MONEY]
    return parts.groupBy(*dims).agg(*counts, *money)


def kpi_report(df: DataFrame, dims: list[Column | str]) -> DataFrame:
    """Group ``df`` by ``dims`` (names or aliased Columns) and compute the KPI vector."""
    return df.groupBy(*dims).agg(*kpi_columns())


def city_counts(df: DataFrame) -> DataFrame:
    """Row count per (province, city), the one SQL report of the platform."""
    return df.groupBy("provincename", "cityname").agg(F.count(F.lit(1)).alias("ct"))

