"""K1-K9 kept up to date: the reports as mergeable day parts.

A day's part is the log summed by all report columns together, in a form that can be subtracted again
without a rest: counts, exact decimals for amounts below ``EXACT_BELOW`` and, for the others (NaN,
infinite, huge), one row per distinct amount with the number of times it counts - a double sum that
holds a NaN or 2 ** 100 could never be taken back. Every report is then a sum over those parts, of all days
(the stored total) or of any of them; the log is read once, when its day is put.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import device_label, int_or_zero, normalise_unknown, os_label
from adlens.operators.dimensions import resolve_app_name
from adlens.operators.kpi import EXACT_BELOW, MONEY, MONEY_DECIMAL, kpi_conditions
from adlens.plans.reports import REPORT_COLUMNS
from adlens.sources.day_store import DayStore

COUNTS = [n for n in S.KPI_NAMES if n not in MONEY]
EXACT = {n: f"{n}_exact" for n in MONEY}
_INTS = {c for c, kind in S.LOG_COLUMNS if kind == "I"}

DIMENSIONS = {
    "location": lambda: ["provincename", "cityname"],
    "os": lambda: [os_label("client").alias("os")],
    "device": lambda: [device_label("devicetype").alias("device")],
    "network": lambda: [normalise_unknown("networkmannername").alias("network")],
    "carrier": lambda: [normalise_unknown("ispname").alias("carrier")],
    "channel": lambda: [int_or_zero("adplatformproviderid").alias("channel")],
}


def report_day(log: DataFrame) -> DataFrame:
    """A day's part: ``group_hash``, the report columns, ``metric`` and ``amount`` (null in the rows of
    counts and exact sums), ``ct``, the seven counts and the two exact sums. One pass over the log."""
    cond = kpi_conditions()
    hit = {n: F.coalesce(c, F.lit(False)) for n, c in cond.items()}
    rows = log.select(*REPORT_COLUMNS, *S.KPI_INPUT_COLUMNS)
    money = {n: F.coalesce(F.col(c), F.lit(0.0)) for n, c in MONEY.items()}
    clean = {n: F.abs(m) < EXACT_BELOW for n, m in money.items()}
    zero = F.lit(0).cast(MONEY_DECIMAL)
    plain = F.struct(
        F.lit(None).cast("string").alias("metric"), F.lit(None).cast("double").alias("amount"), F.lit(1).cast("bigint").alias("ct"),
        *[h.cast("int").cast("bigint").alias(n) for n, h in hit.items()],
        *[F.when(hit["wins"] & clean[n], money[n].cast(MONEY_DECIMAL)).otherwise(zero).alias(EXACT[n]) for n in MONEY])
    rest = [F.when(hit["wins"] & ~clean[n], F.struct(
        F.lit(n).alias("metric"), money[n].alias("amount"), F.lit(1).cast("bigint").alias("ct"),
        *[F.lit(0).cast("bigint").alias(c) for c in COUNTS], *[zero.alias(e) for e in EXACT.values()])) for n in MONEY]
    parts = rows.select(*REPORT_COLUMNS, F.explode(F.array_compact(F.array(plain, *rest))).alias("p"))
    keys = [*REPORT_COLUMNS, "metric", "amount"]
    sums = [F.sum(c).alias(c) for c in ["ct", *COUNTS]] + [F.sum(e).cast(MONEY_DECIMAL).alias(e) for e in EXACT.values()]
    return (parts.select(*REPORT_COLUMNS, "p.*").groupBy(*keys).agg(*sums)
                 .withColumn("group_hash", F.xxhash64(*REPORT_COLUMNS)))


def kpi_of(parts: DataFrame, dims: list) -> DataFrame:
    """The nine-metric vector by ``dims`` from parts."""
    counts = [F.sum(n).alias(n) for n in COUNTS]
    money = [((F.sum(EXACT[n]).cast("double")
               + F.coalesce(F.sum(F.when(F.col("metric") == n, F.col("amount") * F.col("ct"))), F.lit(0.0)))
              / F.lit(1000.0)).alias(n) for n in MONEY]
    return parts.groupBy(*dims).agg(*counts, *money)


class ReportStore(DayStore):
    keys = ["group_hash", *REPORT_COLUMNS, "metric", "amount"]
    values = ["ct", *COUNTS, *EXACT.values()]
    bucket_key, alive = "group_hash", "ct"
    schema = ", ".join(["group_hash bigint", *[f"{c} {'int' if c in _INTS else 'string'}" for c in REPORT_COLUMNS],
                        "metric string", "amount double", "ct bigint", *[f"{c} bigint" for c in COUNTS],
                        *[f"{e} {MONEY_DECIMAL}" for e in EXACT.values()]])

    def put_log(self, dt: str, log: DataFrame) -> None:
        """``log`` as the whole of day ``dt``."""
        self.put(dt, report_day(log))

    def add_log(self, dt: str, log: DataFrame) -> None:
        """Late rows of day ``dt``."""
        self.add(dt, report_day(log))

    def _parts(self, days: list[str] | None) -> DataFrame:
        return self.sums() if days is None else self.sums_of(days)

    def report(self, name: str, days: list[str] | None = None) -> DataFrame:
        """One of ``DIMENSIONS``, over all days or some of them."""
        return kpi_of(self._parts(days), DIMENSIONS[name]())

    def report_app(self, app_dict: DataFrame, days: list[str] | None = None, **join_kw) -> DataFrame:
        named = resolve_app_name(self._parts(days), app_dict, S.APP_REPORT_DEFAULT, "app", **join_kw)
        return kpi_of(named, ["app"])

    def city_count(self, days: list[str] | None = None) -> DataFrame:
        plain = self._parts(days).filter(F.col("metric").isNull())
        return plain.groupBy("provincename", "cityname").agg(F.sum("ct").alias("ct"))
