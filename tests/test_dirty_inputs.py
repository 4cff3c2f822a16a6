"""Dirty and awkward inputs: amounts, dictionary files, short lines, geocoder results, sessions."""

import math

import pytest
from pyspark.sql import functions as F

from adlens import schema as S
from adlens.operators.geo import missing_cells, upsert_cells
from adlens.operators.kpi import kpi_from_parts, kpi_parts, kpi_report
from adlens.operators.perturb import perturb_lines
from adlens.plans import reports as R
from adlens.plans.jobs import report_jobs
from adlens.session import ensure_checkpoint_dir
from adlens.sources.dictionaries import load_app_dict

_EMPTY = {"S": "", "I": 0, "D": 0.0}


def _log(spark, prices):
    rows = []
    for p in prices:
        r = {"winprice": p, "iseffective": 1, "isbilling": 1, "isbid": 1, "iswin": 1, "adorderid": 5}
        rows.append(tuple(r.get(n, _EMPTY[k]) for n, k in S.LOG_COLUMNS))
    return spark.createDataFrame(rows, S.LOG_SCHEMA)


@pytest.mark.parametrize("prices, want", [
    ([1000.0, float("nan")], math.nan), ([1000.0, float("inf")], math.inf), ([1.0, float("-inf")], -math.inf),
    ([float("inf"), float("-inf")], math.nan), ([1e30, 1000.0], 1e27), ([0.1] * 30, 0.003), ([-2e15, 5.0], -2e12 + 0.005),
    ([1e28] * 20, 2e26)])
def test_money_sums_follow_double_arithmetic(spark, prices, want):
    log = _log(spark, prices)
    for got in (kpi_report(log, ["cityname"]), kpi_from_parts(kpi_parts(log, ["cityname", "winprice"]), ["cityname"])):
        row = got.first()
        assert row["wins"] == len(prices)
        assert (math.isnan(want) and math.isnan(row["win_price_k"])) or row["win_price_k"] == pytest.approx(want, rel=1e-12)


def test_dictionary_lines_follow_file_order(spark, tmp_path):
    (tmp_path / "part-00000").write_text("1\tfirst\tx\ty\tk1\n", encoding="utf-8")
    filler = "".join(f"{i}\tn{i}\tx\ty\tother{i}\n" for i in range(5000))
    (tmp_path / "part-00001").write_text(filler + "2\tsecond\tx\ty\tk1\n", encoding="utf-8")
    got = load_app_dict(spark, str(tmp_path)).filter("appid = 'k1'").first()
    assert got["appname_dict"] == "second"


def test_perturbation_keeps_every_line(spark):
    lines = [",".join(str(i) for i in range(n)) for n in (1, 3, 84, 85, 90)] + ["", None, "0,0,0"]
    got = [r["value"] for r in perturb_lines(spark.createDataFrame([(x,) for x in lines], "value string"), 3).collect()]
    assert [None if x is None else len(x.split(",")) for x in got] == [1, 3, 84, 85, 85, 1, None, 3]
    assert got[-1].split(",")[:2] == ["0", "0"] and got[-1].split(",")[2] in ("0", "1")


def _response(name):
    return '{"status":"1","regeocode":{"addressComponent":{"businessAreas":[{"name":"%s"}]}}}' % name


def test_new_geocoder_results_replace_old_ones(spark):
    dim = spark.createDataFrame([("aaaaaa", "old"), ("bbbbbb", "keep"), ("cccccc", "still")], "geohash6 string, business_areas string")
    new = spark.createDataFrame(
        [("aaaaaa", _response("z1"), 1), ("aaaaaa", _response("a2"), 2), ("cccccc", '{"status":"0"}', 3),
         ("dddddd", _response("n"), 1)], "geohash6 string, response string, at int")
    got = {r["geohash6"]: r["business_areas"] for r in upsert_cells(dim, new, order_col="at").collect()}
    assert got == {"aaaaaa": "a2", "bbbbbb": "keep", "cccccc": "still", "dddddd": "n"}


def test_representative_point_is_a_point_of_a_row(spark):
    pts = spark.createDataFrame([("116.30001", "39.90003"), ("116.30002", "39.90001")], "long string, lat string")
    dim = spark.createDataFrame([], "geohash6 string, business_areas string")
    got = missing_cells(pts, dim).collect()
    assert [(r["long"], r["lat"]) for r in got] == [(116.30001, 39.90003)]


def test_reports_read_the_log_once(spark, tmp_path):
    log = _log(spark, [1000.0, 2000.0])
    parts = R.report_parts(log)
    for name, fn in R.REPORTS.items():
        assert fn(log).collect() == R.REPORTS_FROM_PARTS[name](parts).collect()
    path = str(tmp_path / "log")
    log.write.parquet(path)
    seen = []
    import adlens.plans.jobs as J
    original = J.read_log

    def counted(session, where):
        seen.append(where)
        return original(session, where)
    J.read_log = counted
    try:
        report_jobs(spark, path, None, str(tmp_path / "out"))
    finally:
        J.read_log = original
    assert len(seen) == 1
    assert spark.read.json(str(tmp_path / "out" / "city_count")).agg(F.sum("ct")).first()[0] == 2


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()
        conf = Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_derived_tables_notice_a_changed_input(spark, tmp_path):
    import shutil

    from adlens.sources.derived import derived_log
    folder = tmp_path / "sf"
    folder.mkdir()
    shutil.copy("/root/testdata/sf0.001/events.parquet", folder / "events.parquet")
    before = derived_log(spark, str(folder)).count()
    (folder / "events.parquet").chmod(0o644)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(10).toPandas()
    events.to_parquet(folder / "events.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    assert before > 10 and derived_log(spark, str(folder)).count() == 10
