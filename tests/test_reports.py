"""KPI properties over the derived ad-log."""

from pyspark.sql import functions as F

from adlens import schema as S
from adlens.plans import reports as R
from adlens.sources.derived import derived_log
from fixtures_small import SF_SMALL


def _totals(df):
    row = df.agg(*[F.sum(m).alias(m) for m in S.KPI_NAMES]).first()
    return tuple(round(row[m], 6) for m in S.KPI_NAMES)


def test_totals_equal_over_all_dimensions(spark):
    log = derived_log(spark, SF_SMALL)
    expect = _totals(R.kpi_totals(log))
    for name, fn in R.REPORTS.items():
        assert _totals(fn(log)) == expect, name
    assert expect[0] > 0 and expect[6] > 0


def test_metric_ordering(spark):
    for r in R.report_location(derived_log(spark, SF_SMALL)).collect():
        assert r.ad_req <= r.valid_req <= r.raw_req
        assert r.wins <= r.bids
        assert r.win_price_k >= 0 and r.ad_payment_k >= 0


def test_hand_computed_vector(spark):
    rows = [
        # requestmode, processnode, iseffective, isbilling, isbid, iswin, adorderid, winprice, adpayment
        (1, 1, 1, 1, 1, 1, 5, 2000.0, 4000.0),
        (1, 3, 1, 1, 1, 1, 0, 1000.0, 1000.0),   # adorderid 0: a bid, not a win
        (2, 0, 1, 0, 0, 0, 0, 0.0, 0.0),
        (3, 0, 1, 0, 0, 0, 0, 0.0, 0.0),
        (3, 0, 0, 0, 0, 0, 0, 0.0, 0.0),
    ]
    schema = ("requestmode int, processnode int, iseffective int, isbilling int, isbid int, iswin int, "
              "adorderid int, winprice double, adpayment double")
    df = spark.createDataFrame(rows, schema).withColumn("k", F.lit("x"))
    r = R.kpi_report(df, ["k"]).first() if hasattr(R, "kpi_report") else None
    from adlens.operators.kpi import kpi_report
    r = kpi_report(df, ["k"]).first()
    assert (r.raw_req, r.valid_req, r.ad_req, r.shows, r.clicks, r.bids, r.wins) == (2, 1, 1, 1, 1, 2, 1)
    assert (r.win_price_k, r.ad_payment_k) == (2.0, 4.0)
