"""End-to-end jobs on files: raw text -> Parquet -> reports and profiles."""

import os
import tempfile

from adlens.plans.jobs import etl_job, profile_job, report_jobs
from adlens.sources.derived import raw_log_path
from fixtures_small import SF_SMALL


def test_jobs_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="adlens-jobs-")
    log_path = os.path.join(d, "log")
    etl_job(spark, raw_log_path(spark, SF_SMALL), log_path)
    assert spark.read.parquet(log_path).count() == 900  # 1 000 events, every 10th line is short

    dict_path = os.path.join(d, "app_dict.txt")
    with open(dict_path, "w", encoding="utf-8") as f:
        f.write("1\tname0\tx\ty\tcom.app.0\n2\tname1\tx\ty\tcom.app.1\n")
    stop_path = os.path.join(d, "stopwords.txt")
    with open(stop_path, "w", encoding="utf-8") as f:
        f.write("drama\n")
    report_jobs(spark, log_path, dict_path, os.path.join(d, "reports"))
    lines = spark.read.text(os.path.join(d, "reports", "location")).collect()
    pairs = spark.read.parquet(log_path).select("provincename", "cityname").distinct().count()
    assert len(lines) == pairs and all(r.value.startswith("(") for r in lines)
    assert spark.read.text(os.path.join(d, "reports", "app")).count() > 0

    profile_job(spark, log_path, os.path.join(d, "profiles"), "20190922", dict_path, stop_path,
                resolve_people=False)
    profile_job(spark, log_path, os.path.join(d, "people"), "20190922", dict_path, stop_path)
    users = spark.read.parquet(os.path.join(d, "profiles"))
    people = spark.read.parquet(os.path.join(d, "people"))
    assert users.count() > 0 and people.count() > 0
    assert people.filter("tags LIKE '%(Kdrama,%'").count() == 0
