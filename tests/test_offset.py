from __future__ import annotations

import datetime as dt

import pytest

from tessera.operators import offset
from tessera.operators.aggregates import PAGE, Aggregate
from tessera.plans.query import ORDERS, query
from tessera.schema import Attribute, Resource
from tessera.sources.repo import FrameRepo

ITEMS = Resource("items", (Attribute("id", "integer", primary_key=True), Attribute("kind"), Attribute("size", "double"), Attribute("at", "naive_datetime")))


@pytest.fixture(scope="module")
def repo(spark):
    kinds, sizes = [None, "a", "b", ""], [None, 1.0, float("nan"), -3.0, 2.5]
    rows = [(i, kinds[i % 4], sizes[i % 5], dt.datetime(2024, 3, 31, 2, i % 3)) for i in range(600)]
    return FrameRepo(spark, {"items": spark.createDataFrame(rows, ITEMS.schema()).repartition(3)})


def test_an_offset_without_a_limit_has_no_single_task(repo):
    q = query(ITEMS).select("id").sort(("id", "desc")).offset(250)
    found = q.to_df(repo)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Offset" not in plan and "Limit" not in plan
    assert [r.id for r in found.collect()] == [*range(349, -1, -1)]
    assert [r.id for r in q.limit(PAGE).run(repo)] == [*range(349, -1, -1)]
    assert q.offset(600).run(repo) == [] and q.offset(10**12).run(repo) == []


@pytest.mark.parametrize("sorts", [[("kind", "asc_nils_first"), ("size", "desc")], [("at", "desc"), ("id", "asc")]])
def test_rows_from_a_place_on(repo, monkeypatch, sorts):
    monkeypatch.setattr(offset, "FEW", 60)
    rows = repo.scan(ITEMS)
    rest = [(c, "asc") for c in rows.columns if c not in dict(sorts)]
    order = [ORDERS[o](rows[c]) for c, o in [*sorts, *rest]]
    whole = [repr(r) for r in rows.orderBy(*order).collect()]
    for n in (1, 299):
        assert sorted(repr(r) for r in offset.skip(rows, sorts, n, ORDERS).collect()) == sorted(whole[n:])


def test_copies_and_groups(spark, repo):
    copies = spark.createDataFrame([(1, "x")] * 5 + [(0, "y")] * 2 + [(2, "z")], "id long, kind string")
    assert sorted(map(tuple, offset.skip(copies, [("id", "asc")], 4, ORDERS).collect())) == [(1, "x")] * 3 + [(2, "z")]
    groups = query(ITEMS).group_by("kind", "size", aggregates=(Aggregate("n", "count"),)).sort("kind").offset(7)
    assert [r.n for r in groups.run(repo)] == [30] * 13
    assert [r.kind for r in query(ITEMS).distinct("kind").sort("kind").offset(1).run(repo)] == ["a", "b", None]
