"""The sink writes the same weights three times; they are summed once."""

from adlens.plans import catalog

SF = "/root/testdata/sf0.001"


def test_weights_are_summed_once_for_all_writes(spark, monkeypatch):
    sums, writes = [], []
    weights, write = catalog._weights, catalog.write_profiles
    monkeypatch.setattr(catalog, "_weights", lambda *a: (sums.append(1), weights(*a))[1])
    monkeypatch.setattr(catalog, "write_profiles", lambda df, path, dt: (writes.append(dt), write(df, path, dt))[1])
    got = catalog.QUERIES["profile_sink"](spark, SF)
    days = {}
    for r in got.collect():
        days.setdefault(r.dt, set()).add((r.user_key, r.chunk, r.n_tags, r.tags))
    rendered = {tuple(r) for r in catalog.QUERIES["profile_rendered"](spark, SF).collect()}
    assert days == {"20190921": rendered, "20190922": rendered}
    assert writes == ["20190921", "20190922", "20190922"] and len(sums) == 1
