"""Profiles without hubs: rows are summed by their first id, and only rows that begin with a hub by their list."""

import pytest

from adlens import schema as S
from adlens.operators import identity as I
from adlens.operators.hubs import hub_ids
from adlens.operators.tags import TagContext
from adlens.plans import profiles as P


def _log(spark):
    ids = [("p", f"m{i}", f"a{i}") for i in range(20)] + [(f"i{i}", f"m{i}", "") for i in range(20)]
    ids += [("p", "", ""), ("p", None, " "), ("", "", ""), (None, None, None), ("p", "", "lone"), ("i3", "m3", "")]
    defaults = {"S": "", "I": 0, "D": 0.0}
    rows = [{"sessionid": f"s{n}", "imei": a, "mac": b, "androidid": c, "client": n % 4, "provincename": f"P{n % 3}"}
            for n, (a, b, c) in enumerate(ids)]
    return spark.createDataFrame([tuple(r.get(n, defaults[k]) for n, k in S.LOG_COLUMNS) for r in rows], S.LOG_SCHEMA)


@pytest.mark.parametrize("planted", [True, False])
def test_equal_to_a_loop_and_lists_only_where_needed(spark, monkeypatch, planted):
    log, keyed = _log(spark), []
    hubs = hub_ids(I.with_ids(log), default=10 if planted else 1000)
    assert [r.id for r in hubs.collect()] == ["IMp"] * planted
    tags = P.row_tags
    monkeypatch.setattr(P, "row_tags", lambda df, f, ctx, keys: (keyed.append(df), tags(df, f, ctx, keys))[1])
    labels = {r.id: r.component for r in P.resolve_identities(log, hubs=hubs).collect()}
    want = {(c, "id", i): 0 for i, c in labels.items()}
    for r in I.with_ids(log).collect():
        head = next((i for i in r.ids if not planted or i != "IMp"), None)
        if head is not None:
            key = (labels[head], "location", f"ZP{r.provincename}")
            want[key] = want.get(key, 0) + 1
    lists = P.id_lists(log)
    assert lists.count() == 43
    again = P.person_profiles(log, TagContext(), ["location"], hubs=hubs, lists=lists).collect()
    got = P.person_profiles(log, TagContext(), ["location"], hubs=hubs).collect()
    assert sorted(got) == sorted(again)
    assert {(r.component, r.kind, r.tag): r.weight for r in got} == want and len(got) == len(want)
    # A row that does not begin with a hub carries its first id alone.
    rows = keyed[0].select("imei", "__id", "__ids").collect()
    assert all((r["__ids"] is None) != (planted and r.imei == "p") and (r["__id"] is None) == (planted and r.imei == "p") for r in rows)
