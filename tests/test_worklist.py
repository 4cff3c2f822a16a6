"""The geocoder worklist as a stream: each cell once, over restarts, until its state has expired."""

import time

from adlens import schema as S
from adlens.operators import geo as G
from adlens.sources.derived import derived_log
from adlens.streaming.incremental import read_log_stream
from adlens.streaming.worklist import read_worklist, start_worklist
from fixtures_small import SF_SMALL


def _dim(spark, cells):
    return spark.createDataFrame([(c, "A") for c in cells], "geohash6 string, business_areas string")


def _run(spark, base, dim, ask_again="7 days"):
    start_worklist(read_log_stream(spark, f"{base}/log/*"), lambda s: _dim(s, dim), f"{base}/cells", f"{base}/state",
                   ask_again).awaitTermination(300)
    return sorted((r.geohash6, r.batch) for r in read_worklist(spark, f"{base}/cells").collect())


def test_three_folders_with_restarts(spark, tmp_path):
    log = derived_log(spark, SF_SMALL)
    cells = sorted({r[0] for r in G.in_box_cells(log.select("long", "lat")).select(G.CELL).collect()})
    known, base = cells[::3], str(tmp_path)
    for part in range(3):  # the second folder overlaps the first one wholly
        log.filter("sessionid like '%1' or sessionid like '%2'" if part == 0 else "true" if part == 2 else
                   "sessionid like '%2'").write.parquet(f"{base}/log/part={part}")
        got = [c for c, _ in _run(spark, base, known)]
        assert len(got) == len(set(got))
    assert got == [c for c in cells if c not in known]
    points = {r.geohash6: (r.long, r.lat) for r in read_worklist(spark, f"{base}/cells").collect()}
    again = G.with_cell(spark.createDataFrame([(c, str(x), str(y)) for c, (x, y) in points.items()], "c string, long string, lat string"))
    assert again.filter("c <> geohash6").isEmpty()


def test_an_expired_cell_is_asked_for_again_unless_answered(spark, tmp_path):
    base = str(tmp_path)
    row = {c: None for c in S.LOG_COLUMN_NAMES}
    rows = [tuple({**row, "long": x, "lat": "30.0"}[c] for c in S.LOG_COLUMN_NAMES) for x in ("100.0", "110.0")]
    frame = spark.createDataFrame(rows, S.LOG_SCHEMA)
    a, b = (r[0] for r in G.in_box_cells(frame.select("long", "lat")).select(G.CELL).collect())
    for part in range(3):
        frame.write.parquet(f"{base}/log/part={part}")
        got = _run(spark, base, [a] if part else [], ask_again="1 second")
        time.sleep(2.5)
    assert [c for c, _ in got].count(a) == 1 and [c for c, _ in got].count(b) >= 2
