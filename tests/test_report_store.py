"""Reports as day parts: after late and replaced days they equal a recount of the log."""

import math

import pytest
from pyspark.sql import functions as F

from adlens.plans import reports as R
from adlens.plans.report_store import DIMENSIONS, ReportStore
from adlens.sources import derived as D
from adlens.sources.dictionaries import parse_app_dict
from fixtures_small import SF_SMALL

N = "cast(substring(sessionid, 2, 10) as int)"


def _rows(df):
    """Rows with NaN as text, so that they compare."""
    return sorted(repr(tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r))
                  for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture(scope="module")
def log(spark):
    return D.derived_log(spark, SF_SMALL).withColumn("winprice", F.expr(D.dirty_price_expr()))


def test_reports_equal_a_recount(spark, log, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"), 8)
    store.put_log("d1", log.filter(f"{N} % 2 == 0"))
    store.put_log("d2", log)                        # a wrong day, with NaN and infinite amounts in it
    store.put_log("d2", log.filter(f"{N} % 4 == 1"))
    store.add_log("d2", log.filter(f"{N} % 4 == 3"))     # late rows
    for name in DIMENSIONS:
        assert _rows(store.report(name)) == _rows(R.REPORTS[name](log)), name
    assert _rows(store.city_count()) == _rows(R.report_city_count(log))
    assert _rows(store.report("os", ["d1"])) == _rows(R.report_os(log.filter(f"{N} % 2 == 0")))
    words = parse_app_dict(D.app_dict_lines(spark, SF_SMALL), True)
    assert _rows(store.report_app(words)) == _rows(R.report_app(log, words))


def test_what_was_put_is_taken_back_without_a_rest(spark, log, tmp_path):
    store = ReportStore(spark, str(tmp_path / "r"), 4)
    one = log.limit(1).withColumns({"requestmode": F.lit(1), "processnode": F.lit(3), "iseffective": F.lit(1), "isbilling": F.lit(1),
                                    "isbid": F.lit(1), "iswin": F.lit(1), "adorderid": F.lit(5)})
    price = lambda x: one.withColumns({"winprice": F.lit(x).cast("double"), "adpayment": F.lit(0.1)})
    store.put_log("a", price(0.3))
    for amount in (float("nan"), float("inf"), float("-inf"), 1e300, 1e15, -0.0):
        store.put_log("b", price(amount))
    store.add_log("b", price(float("nan")))
    assert math.isnan(store.report("os").first()["win_price_k"])
    store.put_log("b", price(0.6))
    row = store.report("os").collect()
    assert len(row) == 1 and row[0]["win_price_k"] == 0.9 / 1000 and row[0]["wins"] == 2 and row[0]["ad_payment_k"] == 0.2 / 1000
    store.put_log("b", log.limit(0))
    store.put_log("a", log.limit(0))
    assert store.report("os").isEmpty() and store.city_count().isEmpty()
