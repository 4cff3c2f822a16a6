"""Plan assertions: pruned scans, no Python UDFs, broadcast only behind checks."""

import __spark_entry__ as E
from adlens.plans.catalog import QUERIES
from fixtures_small import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_scan_is_pruned(spark):
    plan = _plan(E.queries()["kpi_by_location"](spark, SF_SMALL))
    scanned = plan.split("FileScan parquet [")[1].split("]")[0]
    cols = {c.split("#")[0] for c in scanned.split(",")}
    assert cols == {"provincename", "cityname", "requestmode", "processnode", "iseffective", "isbilling",
                    "isbid", "iswin", "adorderid", "winprice", "adpayment"}
    assert plan.count("Exchange hashpartitioning") == 1


def test_no_python_udfs_anywhere(spark):
    for name, q in QUERIES.items():
        plan = _plan(q(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, (name, node)


def test_app_dictionary_is_broadcast(spark):
    plan = _plan(E.queries()["kpi_by_app"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_dimension_not_broadcast_above_bound(spark):
    from pyspark.sql import functions as F
    from adlens.operators.dimensions import join_dimension
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k")
    plan = join_dimension(big, dim, "k", "left", max_broadcast_rows=5)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "broadcast" not in plan.lower()


def test_measure_counts_rows_and_bytes(spark):
    from adlens.operators.dimensions import measure
    df = spark.createDataFrame([("ab", 1), ("电视", 2), (None, 3)], "s string, i int")
    assert measure(df) == (3, 2 + 6 + 0 + 3 * 4)


def test_dimension_not_broadcast_above_byte_bound(spark):
    from pyspark.sql import functions as F
    from adlens.operators.dimensions import join_dimension
    big = spark.range(100).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k").withColumn("pad", F.lit("x" * 100))
    plan = join_dimension(big, dim, "k", "left", max_broadcast_bytes=500)._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
