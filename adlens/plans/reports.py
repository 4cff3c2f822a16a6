"""The eight reports (KPI by seven dimensions + row count by province/city)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.functions.scalar import device_label, int_or_zero, normalise_unknown, os_label
from adlens.operators.dimensions import resolve_app_name
from adlens.operators.kpi import city_counts, kpi_from_parts, kpi_parts, kpi_report


def _kpi_input(log: DataFrame, *extra: str) -> DataFrame:
    return log.select(*extra, *S.KPI_INPUT_COLUMNS)


def report_location(log: DataFrame) -> DataFrame:
    return kpi_report(log, ["provincename", "cityname"])


def report_os(log: DataFrame) -> DataFrame:
    return kpi_report(log, [os_label("client").alias("os")])


def report_device(log: DataFrame) -> DataFrame:
    return kpi_report(log, [device_label("devicetype").alias("device")])


def report_network(log: DataFrame) -> DataFrame:
    return kpi_report(log, [normalise_unknown("networkmannername").alias("network")])


def report_carrier(log: DataFrame) -> DataFrame:
    return kpi_report(log, [normalise_unknown("ispname").alias("carrier")])


def report_channel(log: DataFrame) -> DataFrame:
    return kpi_report(log, [int_or_zero("adplatformproviderid").alias("channel")])


def report_app(log: DataFrame, app_dict: DataFrame, **join_kw) -> DataFrame:
    named = resolve_app_name(_kpi_input(log, "appid", "appname"), app_dict,
                             S.APP_REPORT_DEFAULT, "app", **join_kw)
    return kpi_report(named, ["app"])


def report_city_count(log: DataFrame) -> DataFrame:
    return city_counts(log)


REPORTS = {
    "location": report_location,
    "os": report_os,
    "device": report_device,
    "network": report_network,
    "carrier": report_carrier,
    "channel": report_channel,
}


# All reports from one pass: the log is summed by every report column together, and each report
# sums those groups further. Labels are applied to the groups, not to the rows.
REPORT_COLUMNS = ["provincename", "cityname", "client", "devicetype", "networkmannername", "ispname",
                  "adplatformproviderid", "appid", "appname"]


def report_parts(log: DataFrame) -> DataFrame:
    return kpi_parts(log, REPORT_COLUMNS)


REPORTS_FROM_PARTS = {
    "location": lambda p: kpi_from_parts(p, ["provincename", "cityname"]),
    "os": lambda p: kpi_from_parts(p, [os_label("client").alias("os")]),
    "device": lambda p: kpi_from_parts(p, [device_label("devicetype").alias("device")]),
    "network": lambda p: kpi_from_parts(p, [normalise_unknown("networkmannername").alias("network")]),
    "carrier": lambda p: kpi_from_parts(p, [normalise_unknown("ispname").alias("carrier")]),
    "channel": lambda p: kpi_from_parts(p, [int_or_zero("adplatformproviderid").alias("channel")]),
}


def app_from_parts(parts: DataFrame, app_dict: DataFrame, **join_kw) -> DataFrame:
    return kpi_from_parts(resolve_app_name(parts, app_dict, S.APP_REPORT_DEFAULT, "app", **join_kw), ["app"])


def city_count_from_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("provincename", "cityname").agg(F.sum("ct").alias("ct"))


def kpi_totals(log: DataFrame) -> DataFrame:
    """Grand total of the KPI vector (used by the invariance property tests)."""
    return kpi_report(log.withColumn("__all", F.lit(1)), ["__all"]).drop("__all")
