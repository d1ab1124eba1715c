from __future__ import annotations

import uuid

import pytest

from tessera.config import Config
from tessera.errors import QueryError
from tessera.functions.predicates import Always, Leaf, attr, columns_of
from tessera.plans.query import query
from tessera.schema import Attribute, Resource
from tessera.sources.repo import FrameRepo

USERS = Resource("users", (Attribute("id", "uuid", primary_key=True), Attribute("name"), Attribute("age", "integer")))
ROWS = [(str(uuid.UUID(int=i)), n, a) for i, (n, a) in enumerate([("alice", 30), ("BOB", 25), ("100%", 0), ("a_b", 1), ("back\\slash", None), (None, 40)])]


@pytest.fixture(scope="module")
def repo(spark):
    return FrameRepo(spark, {"users": spark.createDataFrame(ROWS, USERS.schema())})


def ages(repo, *filters, config=None):
    if config:
        repo = FrameRepo(repo.spark, repo.frames, config)
    return sorted((r["age"] for r in query(USERS).filter(*filters).select("age").run(repo)), key=lambda x: (x is None, x))


@pytest.mark.parametrize(
    ("shape", "want"),
    [
        (attr("age") == 30, [30]),
        (attr("age") != 30, [0, 1, 25, 40]),
        (("age", "<>", 30), [0, 1, 25, 40]),
        (attr("age") > 25, [30, 40]),
        (attr("age") >= 25, [25, 30, 40]),
        (attr("age") < 1, [0]),
        (attr("age") <= 1, [0, 1]),
        (attr("age").is_in([0, 40]), [0, 40]),
        (attr("age").is_in({25}), [25]),
        (attr("age").is_in(25), [25]),
        (attr("age").is_in([]), []),
        (attr("age").not_in([]), [0, 1, 25, 30, 40, None]),
        (attr("age").not_in([0, 1]), [25, 30, 40]),
        (~(attr("age") > 25), [0, 1, 25]),
        ((attr("age") > 25) | attr("name").is_nil(), [30, 40]),
        ((attr("age") > 25) & attr("name").is_nil(), [40]),
        (attr("age").is_nil(), [None]),
        (attr("age").is_nil(False), [0, 1, 25, 30, 40]),
        (attr("name").contains("bo"), [25]),
        (attr("name").contains("%"), [0]),
        (attr("name").contains("_"), [1]),
        (attr("name").like("a%"), [1, 30]),
        (attr("name").ilike("b_b"), [25]),
        (attr("name").starts_with("a_"), [1]),
        (attr("name").ends_with("0%"), [0]),
        (attr("name").ends_with("\\slash"), [None]),
        ({"name": "alice"}, [30]),
        ({"op": "eq", "name": "age", "right": {"value": 25}}, [25]),
        (attr("age") == None, []),  # noqa: E711
        (Always(True), [0, 1, 25, 30, 40, None]),
        (False, []),
    ],
)
def test_operator(repo, shape, want):
    assert ages(repo, shape) == want


def test_filters_are_joined_by_and(repo):
    assert ages(repo, attr("age") > 0, attr("age") < 30) == [1, 25]


def test_case_sensitive_contains(repo):
    assert ages(repo, attr("name").contains("bo"), config=Config(contains_case_sensitive=True)) == []


def test_uuid_values_are_normalised(repo):
    key = uuid.UUID(int=1)
    for value in (key, key.bytes, str(key).upper()):
        assert ages(repo, attr("id") == value) == [25]
    assert ages(repo, attr("id").is_in([key.bytes])) == [25]


@pytest.mark.parametrize("bad", [attr("nope") == 1, ("age", "near", 3), attr("age") == attr("name"), object(), (attr("age") > 1) & (attr("nope") == 1), ~(attr("nope") == 1)])
def test_untranslatable_filters_fail_closed(repo, bad):
    with pytest.raises(QueryError):
        ages(repo, bad)
    assert len(ages(repo, bad, config=Config(raise_on_untranslatable_filter=False))) == 6


def test_columns_of():
    assert columns_of([(attr("a") == 1) | ~(attr("b") > 2), Leaf("c", "eq", 1)]) == {"a", "b", "c"}


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "users.parquet")
    spark.createDataFrame(ROWS, USERS.schema()).write.parquet(path)
    from tessera.sources.repo import ParquetRepo

    plan = query(USERS).filter(attr("age") > 25).select("age").to_df(ParquetRepo(spark, str(tmp_path)))._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThan(age,25)" in plan
    assert "ReadSchema: struct<age:bigint>" in plan
