from __future__ import annotations

import decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera import telemetry
from tessera.capabilities import ABSENT, FEATURES, can
from tessera.config import Config
from tessera.errors import QueryError
from tessera.functions.predicates import attr
from tessera.operators.aggregates import Aggregate
from tessera.operators.calculations import Calculation
from tessera.plans.query import query
from tessera.schema import Attribute, Relationship, Resource
from tessera.sources.repo import FrameRepo
from tessera.streaming.chunks import chunks

USERS = Resource("users", (Attribute("id", "integer", primary_key=True), Attribute("name"), Attribute("age", "integer"), Attribute("org")), tenancy="attribute", tenant_attribute="org")
TEAMS = Resource("teams", (Attribute("id", "integer", primary_key=True), Attribute("name")), relationships=(Relationship("members", "has_many", lambda: MEMBERS, "id", "team_id"), Relationship("twins", "belongs_to", lambda: PAIRS, "id", "a")))
MEMBERS = Resource("members", (Attribute("id", "integer", primary_key=True), Attribute("team_id", "integer"), Attribute("pay", "decimal")), relationships=(Relationship("team", "belongs_to", TEAMS, "team_id", "id"),))
PAIRS = Resource("pairs", (Attribute("a", "integer", primary_key=True), Attribute("b", "integer", primary_key=True)))


@pytest.fixture(scope="module")
def repo(spark):
    d = decimal.Decimal
    users = [(i, f"u{i % 3}", i, "x" if i % 2 else "y") for i in range(1, 11)] + [(11, None, None, None)]
    members = [(1, 1, d("1.5")), (2, 1, d("2.5")), (3, 2, None), (4, None, d("9"))]
    return FrameRepo(
        spark,
        {
            "users": spark.createDataFrame(users, USERS.schema()), "teams": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], TEAMS.schema()),
            "members": spark.createDataFrame(members, MEMBERS.schema()), "pairs": spark.createDataFrame([(1, 1)], PAIRS.schema()),
        },
    )


def column(rows, name):
    return [r[name] for r in rows]


def test_aggregates_over_a_query(repo):
    kinds = [Aggregate(k, k, None if k == "count" else "age") for k in ("count", "sum", "avg", "min", "max")]
    base = query(USERS).filter(attr("age").is_nil(False))
    assert base.aggregate_values(repo, *kinds) == {"count": 10, "sum": 55, "avg": 5.5, "min": 1, "max": 10}
    assert base.filter(attr("age") >= 5).aggregate_values(repo, kinds[0]) == {"count": 6}
    assert base.filter(attr("age") >= 5, attr("age") <= 7).aggregate_values(repo, *kinds[1:]) == {"sum": 18, "avg": 6.0, "min": 5, "max": 7}
    assert base.sort("age").limit(2).offset(1).aggregate_values(repo, kinds[0]) == {"count": 10}
    assert base.aggregate_values(repo) == {}
    assert query(USERS).aggregate_values(repo, Aggregate("n", "count", "age"), Aggregate("old", "count", filter=attr("age") > 8)) == {"n": 10, "old": 2}


def test_aggregates_over_no_rows(repo):
    got = query(USERS).filter(attr("age") > 99).aggregate_values(repo, Aggregate("n", "count"), Aggregate("s", "sum", "age"), Aggregate("d", "sum", "age", default=0))
    assert got == {"n": 0, "s": None, "d": 0}


@pytest.mark.parametrize("bad", [Aggregate("x", "median", "age"), Aggregate("x", "sum"), Aggregate("x", "sum", "nope")])
def test_bad_aggregates_are_rejected_everywhere(repo, bad):
    with pytest.raises(QueryError):
        query(USERS).aggregate_values(repo, bad)
    with pytest.raises(QueryError):
        query(USERS).aggregate(bad).run(repo)


def test_sort_limit_offset(repo):
    q = query(USERS)
    assert column(q.filter(attr("age") > 0).sort("age").limit(3).offset(2).run(repo), "age") == [3, 4, 5]
    assert column(q.sort("age").run(repo), "age")[-1] is None
    assert column(q.sort(("age", "desc")).run(repo), "age")[-1] is None
    assert column(q.sort(("age", "asc_nils_first")).run(repo), "age")[0] is None
    assert column(q.sort(("age", "desc_nils_first")).limit("2").run(repo), "age") == [None, 10]
    assert column(q.sort("age").sort(("name", "desc")).run(repo), "age")[:3] == [2, 5, 8], "the later sort comes first"
    assert q.limit(0).run(repo) == []
    assert len(q.offset(4).run(repo)) == 7
    for bad in ("x", -1, None, 1.5):
        with pytest.raises(QueryError):
            q.limit(bad)
    with pytest.raises(QueryError):
        q.sort(("age", "sideways"))


def test_pages_make_the_whole(repo):
    q = query(USERS).sort("name")
    whole = column(q.page(100).run(repo), "id")
    assert sum((column(q.page(3, k).run(repo), "id") for k in range(0, 12, 3)), []) == whole


def test_select_and_distinct(repo):
    q = query(USERS)
    assert q.select("name").select("age").to_df(repo).columns == ["age"]
    assert sorted(column(q.distinct("name").run(repo), "name"), key=str) == ["None", "u0", "u1", "u2"] or len(q.distinct("name").run(repo)) == 4
    assert q.select("org").distinct("name").to_df(repo).columns == ["org", "name"]
    assert len(q.distinct("name").sort("age").run(repo)) == 11, "hidden sort columns count for distinct"
    assert q.distinct("name").sort("age").to_df(repo).columns == ["name"]
    assert q.distinct("name").select("age").to_df(repo).columns == ["age"]
    with pytest.raises(QueryError):
        q.select("nope")


def test_group_by(repo):
    got = query(USERS).group_by("org", aggregates=(Aggregate("n", "count"), Aggregate("s", "sum", "age"))).sort("org").run(repo)
    assert [tuple(r) for r in got] == [("x", 5, 25), ("y", 5, 30), (None, 1, None)]
    assert len(query(USERS).group_by("org").run(repo)) == 3


def test_relationship_aggregates(repo):
    got = query(TEAMS).sort("id").aggregate(Aggregate("n", "count", path=("members",), default=0), Aggregate("pay", "sum", "pay", ("members",), default=decimal.Decimal(0))).run(repo)
    assert column(got, "n") == [2, 1, 0]
    assert column(got, "pay") == [decimal.Decimal("4"), 0, 0]
    up = query(MEMBERS).select("id").sort("id").aggregate(Aggregate("team", "max", "name", ("team",)), Aggregate("own", "count")).run(repo)
    assert column(up, "team") == ["a", "a", "b", None]
    assert column(up, "own") == [1, 1, 1, 1]
    assert up[0].asDict().keys() == {"id", "team", "own"}


def test_relationship_aggregates_that_have_a_default_only(repo):
    assert column(query(TEAMS).aggregate(Aggregate("x", "count", path=("members", "team"), default=7)).run(repo), "x") == [7, 7, 7]
    assert column(query(TEAMS).aggregate(Aggregate("x", "count", path=("twins",), default=5)).run(repo), "x") == [5, 5, 5]
    assert column(query(PAIRS).aggregate(Aggregate("x", "count", default=3)).run(repo), "x") == [3]
    with pytest.raises(QueryError):
        query(TEAMS).aggregate(Aggregate("x", "count", path=("nope",))).run(repo)


def test_failed_aggregates_can_fall_back(repo):
    lenient = FrameRepo(repo.spark, {"teams": repo.frames["teams"]}, Config(raise_on_aggregate_failure=False))
    q = query(TEAMS).aggregate(Aggregate("n", "count", path=("members",), default=-1))
    assert column(q.run(lenient), "n") == [-1] * 3
    with pytest.raises(QueryError):
        q.run(FrameRepo(repo.spark, lenient.frames))


def test_tenancy_and_context(repo):
    assert {r["org"] for r in query(USERS).set_tenant("x").run(repo)} == {"x"}
    by_context = Resource("users", USERS.attributes, tenancy="context", default_context={"tenant": "org_1", "a": 1})
    q = query(by_context)
    assert q.tenant == "org_1"
    assert len(q.set_tenant("z").run(repo)) == 11
    assert q.set_context({"a": 2, "b": 3}).context == {"tenant": "org_1", "a": 2, "b": 3}


def test_base_filter_applies_to_reads_and_aggregates(repo):
    active = Resource("active", USERS.attributes, table="users", base_filter=attr("age") > 8)
    assert sorted(column(query(active).run(repo), "age")) == [9, 10]
    assert query(active).aggregate_values(repo, Aggregate("n", "count")) == {"n": 2}


def test_calculations(repo, caplog):
    class Shout:
        @staticmethod
        def calculate(records: pd.DataFrame, options: dict) -> list:
            return [None if n is None else n.upper() + options["mark"] for n in records["name"]]

    q = query(USERS).filter(attr("id") == 1).select("id")
    got = q.calculate(Calculation("twice", F.col("age") * 2), Calculation("four", lambda rows: F.col("twice") * 2), Calculation("loud", Shout, needs=("name",), options={"mark": "!"})).run(repo)
    assert [r.asDict() for r in got] == [{"id": 1, "twice": 2, "four": 4, "loud": "U1!"}]
    assert [r.asDict() for r in q.calculate(Calculation("odd", 42)).run(repo)] == [{"id": 1}]
    assert "not supported" in caplog.text


def test_chunks_equal_the_run(repo):
    q = query(USERS).sort("id").aggregate(Aggregate("own", "count"))
    parts = list(chunks(q, repo, 4))
    assert [len(p) for p in parts] == [4, 4, 3]
    assert [r for p in parts for r in p] == q.run(repo)


def test_telemetry_tells_of_runs_and_failures(repo):
    seen = []
    telemetry.attach("t", lambda event, measured, about: seen.append((event, about.get("status"))))
    try:
        query(USERS).run(repo)
        with pytest.raises(QueryError):
            query(USERS).filter(attr("nope") == 1).run(repo)
    finally:
        telemetry.detach("t")
    assert seen == [("tessera.run_query.start", None), ("tessera.run_query.stop", "ok"), ("tessera.run_query.start", None), ("tessera.run_query.exception", "error")]


def test_raw_sql_and_ping(repo):
    assert repo.ping()
    assert repo.query("SELECT ? + ? AS n", [1, 2]).head()["n"] == 3
    assert repo.query("SELECT count(*) AS n FROM people WHERE age > ?", [5], {"people": USERS}).head()["n"] == 5
    with pytest.raises(QueryError) as e:
        repo.query("SELEC 1")
    assert e.value.query == "SELEC 1"
    assert e.value.reason is not None


def test_records_are_full(repo):
    got = query(TEAMS).select("id").sort("id").limit(1).aggregate(Aggregate("n", "count", path=("members",), default=0)).records(repo)
    assert got == [{"id": 1, "name": None, "aggregates": {"n": 2}}]
    assert query(TEAMS).lock("for_update") == query(TEAMS)


def test_capabilities():
    assert can("stream")
    assert can(("aggregate", "avg"))
    assert can(("filter_expr", "!="))
    assert can(("sort", "desc_nils_first"))
    for feature in ("upsert", "join", ("aggregate", "median"), ("query_aggregate", "list"), ("filter_expr", "near"), "anything"):
        assert not can(feature)
    assert not set(FEATURES) & set(ABSENT)
