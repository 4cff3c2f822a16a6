"""ETL and dictionaries from real text files."""

import os
import tempfile

from adlens import schema as S
from adlens.sources.dictionaries import load_app_dict, load_stopwords
from adlens.sources.rawlog import read_raw_log, type_log
from adlens.sources.sinks import read_log, write_log


def _write(lines):
    d = tempfile.mkdtemp(prefix="adlens-test-")
    p = os.path.join(d, "in.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_raw_log_to_parquet_roundtrip(spark):
    base = [""] * 85
    base[0], base[1], base[8], base[9], base[24] = "s1", "+5", " 1 ", " 2.5 ", "广东省"
    short = ",".join(base[:84])
    extra = ",".join(base) + ",x,y,"
    p = _write([",".join(base), short, extra])
    typed = type_log(read_raw_log(spark, p))
    rows = typed.collect()
    assert len(rows) == 2
    assert [(f.name, f.dataType) for f in typed.schema] == [(f.name, f.dataType) for f in S.LOG_SCHEMA]
    r = rows[0]
    assert (r.sessionid, r.advertisersid, r.requestmode, r.adprice, r.provincename) == ("s1", 5, 0, 2.5, "广东省")
    out = os.path.join(tempfile.mkdtemp(prefix="adlens-test-"), "log")
    write_log(typed, out)
    assert read_log(spark, out).count() == 2


def test_app_dict_variants(spark):
    p = _write(["1\tname1\tx\ty\tk1", "2\tname2\tx\ty\tk1", "3\tname3\tx\ty\t", "4 only four fields"])
    report = {r.appid: r.appname_dict for r in load_app_dict(spark, p, keep_trailing=True).collect()}
    tags = {r.appid: r.appname_dict for r in load_app_dict(spark, p, keep_trailing=False).collect()}
    assert report == {"k1": "name2", "": "name3"}
    assert tags == {"k1": "name2"}


def test_stopwords(spark):
    p = _write(["电视剧", "最新更新", "TV版", "配音语种", "电视剧"])
    assert sorted(r.word for r in load_stopwords(spark, p).collect()) == sorted(S.DEFAULT_STOP_WORDS)
