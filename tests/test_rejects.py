"""Rejected lines: every line has one verdict, good rows are those of the plain ingest, one scan writes both."""

from adlens import schema as S
from adlens.sources.rawlog import ingest_raw_log
from adlens.sources.rejects import REASONS, ingest_with_rejects

GOOD = ",".join(f"v{i}" for i in range(S.N_LOG_FIELDS))
LINES = [GOOD, "", "   ", "# comment", GOOD + ",more,", GOOD[:40], ",".join(["x"] * 84), ",", "," * 84]


def _write(tmp_path, files):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, lines in files.items():
        (raw / name).write_text("".join(x + "\n" for x in lines), encoding="utf-8")
    return str(raw)


def test_every_line_is_good_or_rejected(spark, tmp_path):
    raw = _write(tmp_path, {"a.log": LINES, "b.log": LINES[:4]})
    run = ingest_with_rejects(spark, raw, str(tmp_path / "out"))
    assert run.counts == {"ok": 4, "blank": 4, "no_fields": 2, "few_fields": 3} and run.lines == 13
    plain = ingest_raw_log(spark, raw)
    assert run.log().dtypes == plain.dtypes
    assert run.log().exceptAll(plain).isEmpty() and plain.exceptAll(run.log()).isEmpty()
    got = sorted((r.verdict, r.line, r.n_fields, r.file.rpartition("/")[2]) for r in run.rejected().collect())
    a = [("blank", "", 1), ("blank", "   ", 1), ("no_fields", "# comment", 1)]
    tail = [("few_fields", x, x.count(",") + 1, "a.log") for x in (GOOD[:40], LINES[6], ",")]
    assert got == sorted([(*x, f) for x in a for f in ("a.log", "b.log")] + tail)
    assert all(r.block_start == 0 and r.block_length > 0 for r in run.rejected().collect())


def test_all_good_all_bad_and_nothing(spark, tmp_path):
    for name, lines in {"good": [GOOD], "bad": [""], "none": []}.items():
        folder = tmp_path / name
        folder.mkdir()
        run = ingest_with_rejects(spark, _write(folder, {"x.log": lines}), str(folder / "out"))
        assert run.lines == len(lines)
        assert run.log().count() == (name == "good") and run.rejected().count() == (name == "bad")
        assert run.log().columns == S.LOG_COLUMN_NAMES


def test_settings_are_as_before(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    ingest_with_rejects(spark, _write(tmp_path, {"a.log": LINES}), str(tmp_path / "out"))
    assert spark.conf.get(key) == before and len(REASONS) == 3
