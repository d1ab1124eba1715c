from __future__ import annotations

import datetime as dt
import decimal
import uuid

import pytest
from pyspark.sql import types as T

from tessera import identifiers
from tessera.errors import ConfigurationError, QueryError
from tessera.functions import types
from tessera.functions.predicates import Always, attr
from tessera.operators.aggregates import Aggregate
from tessera.plans import ddl, migrations
from tessera.plans.query import query
from tessera.schema import Attribute, Index, Relationship, Resource
from tessera.sources.repo import CatalogRepo
from tessera.sources.store import CatalogStore, StoreRepo

BULK = Resource(
    "bulk_insert",
    (
        Attribute("id", "uuid", primary_key=True), Attribute("created_at", "utc_datetime"), Attribute("starts_at", "naive_datetime"), Attribute("day", "date"), Attribute("clock", "time"),
        Attribute("amount", "decimal"), Attribute("meta", "map", nullable=False), Attribute("items", ("array", "string"), nullable=False), Attribute("age", "integer"),
    ),
)
PAIR = Resource("pair", (Attribute("a", "integer", primary_key=True), Attribute("b", primary_key=True), Attribute("v", "integer")))


@pytest.fixture
def store(spark, tmp_path):
    return StoreRepo(spark, str(tmp_path / "store"))


def record(i: int) -> dict:
    return {"created_at": "2024-01-02T03:04:05", "starts_at": dt.datetime(2024, 1, 2), "day": 19724, "clock": dt.time(1, 2, 3), "amount": "12.5", "meta": {"k": 1}, "items": ["x", 2], "age": i}


def test_round_trip_of_types(store):
    made = store.insert(BULK, record(1))
    assert uuid.UUID(made["id"])
    got = query(BULK).run(store)[0].asDict()
    assert got["day"] == dt.date(2024, 1, 2)
    assert got["clock"] == "01:02:03"
    assert got["amount"] == decimal.Decimal("12.5")
    assert got["meta"] == {"k": "1"}
    assert got["items"] == ["x", "2"]
    assert got["starts_at"] == dt.datetime(2024, 1, 2)
    assert got["id"] == made["id"]


@pytest.mark.parametrize("n", [0, 1, 20, 100])
def test_bulk_round_trip(store, n):
    made = store.bulk_insert(BULK, [record(i) for i in range(n)], batch_size=40)
    assert len(made) == n
    assert sorted(r["age"] for r in query(BULK).run(store)) == list(range(n))
    assert query(BULK).aggregate_values(store, Aggregate("n", "count")) == {"n": n}
    assert len(store.version(BULK)[1]) == -(-n // 40)


def test_a_failing_batch_keeps_earlier_ones(store):
    with pytest.raises(QueryError):
        store.bulk_insert(PAIR, [{"a": 1, "b": "x"}, {"a": 2}], batch_size=1)
    assert len(query(PAIR).run(store)) == 1
    with pytest.raises(QueryError):
        store.insert(PAIR, {"a": 1, "b": "x", "nope": 1})


def test_update_and_delete(store, spark):
    rows = spark.createDataFrame([(i, "x", None if i == 3 else i) for i in range(6)], "a long, b string, v int")
    store.insert_frame(PAIR, rows)
    store.insert_frame(PAIR, spark.createDataFrame([(9, "y")], "a long, b string"))
    segments = store.version(PAIR)[1]
    back = store.update_query(query(PAIR).filter(attr("v") < 2), {"v": 100})
    assert back.count() == 0, "rows that stopped matching are not returned"
    after = {r["a"]: r["v"] for r in query(PAIR).run(store)}
    assert after == {0: 100, 1: 100, 2: 2, 3: None, 4: 4, 5: 5, 9: None}
    assert segments[1] in store.version(PAIR)[1], "untouched segments are not rewritten"
    assert query(PAIR).to_df(store).schema["v"].dataType == T.LongType()
    store.destroy_query(query(PAIR).filter(attr("v") > 4))
    assert {r["a"] for r in query(PAIR).run(store)} == {2, 3, 4, 9}, "an unknown predicate keeps the row"
    store.update(PAIR, {"a": 2, "b": "x"}, {"v": 7})
    store.update(PAIR, {"a": 2, "b": "z"}, {"v": 8})
    store.destroy(PAIR, {"a": 3, "b": "x"})
    assert {r["a"]: r["v"] for r in query(PAIR).run(store)} == {2: 7, 4: 4, 9: None}
    store.vacuum(PAIR)
    assert len(query(PAIR).run(store)) == 3


def test_mutations_without_a_predicate_are_refused(store):
    store.insert(PAIR, {"a": 1, "b": "x"})
    for bad in (lambda: store.destroy_query(query(PAIR)), lambda: store.update_query(query(PAIR), {"v": 1}), lambda: store.destroy(PAIR, {"a": 1}), lambda: store.update(PAIR, {}, {"v": 1})):
        with pytest.raises(QueryError):
            bad()
    assert store.update(PAIR, {}, {}) == {}
    store.delete_where(PAIR, Always(True))
    assert query(PAIR).run(store) == []


def test_two_writers_of_one_version(store):
    store.insert(PAIR, {"a": 1, "b": "x"})
    number, segments = store.version(PAIR)
    store._commit(PAIR, number, segments)
    with pytest.raises(QueryError):
        store._commit(PAIR, number, segments)


def test_missing_table(store):
    with pytest.raises(QueryError):
        query(PAIR).run(store)


OWNED = Resource(
    "owned", (Attribute("id", "uuid", primary_key=True), Attribute("org"), Attribute("meta", "map", nullable=False), Attribute("n", "integer"), Attribute("made", "integer", default=lambda: 1)),
    tenancy="attribute", tenant_attribute="org", default_context={"tenant": "o1"},
)


def test_updates_decode_and_refuse_nulls(store):
    one = store.insert(OWNED, {"org": "o1", "meta": {}, "n": "12 apples"})
    key, other = uuid.UUID(one["id"]), uuid.uuid4()
    store.update(OWNED, {"id": key}, {"meta": {"a": 1}, "n": "7x", "org": "o2"})
    got = store.scan(OWNED).collect()[0]
    assert (got["meta"], got["n"], got["org"]) == ({"a": "1"}, 7, "o2")
    store.update(OWNED, {"id": str(key).upper()}, {"id": other})
    assert store.scan(OWNED).collect()[0]["id"] == str(other)
    for name in ("id", "meta"):
        with pytest.raises(QueryError):
            store.update(OWNED, {"id": other}, {name: None})
    store.update(OWNED, {"id": other}, {"n": None})
    assert store.scan(OWNED).collect()[0]["n"] is None


def test_frames_are_typed(store, spark):
    key = str(uuid.uuid4()).upper()
    rows = spark.createDataFrame([(key, "o1", {"a": "b"}, 5, 1)], "id string, org string, meta map<string,string>, n int, made long")
    store.insert_frame(OWNED, rows)
    assert [r["n"] for r in query(OWNED).filter(attr("id") == key).run(store)] == [5]
    for bad in (rows.drop("made"), rows.drop("meta"), rows.selectExpr("id", "org", "cast(null as map<string,string>) as meta", "n", "made")):
        with pytest.raises(QueryError):
            store.insert_frame(OWNED, bad)
    assert store.scan(OWNED).count() == 1


def test_a_default_tenant_filters(store):
    store.bulk_insert(OWNED, [{"org": o, "meta": {}, "n": i} for i, o in enumerate(["o1", "o2", None])])
    assert [r["org"] for r in query(OWNED).run(store)] == ["o1"]
    assert query(OWNED).tenant == "o1"


def test_mutations_by_part_of_a_query_are_refused(store):
    store.bulk_insert(PAIR, [{"a": 1, "b": "x"}, {"a": 1, "b": "y"}])
    hits = query(PAIR).filter(attr("a") == 1)
    for bad in (hits.limit(1), hits.offset(1), hits.distinct("a"), hits.group_by("a")):
        with pytest.raises(QueryError):
            store.destroy_query(bad)
        with pytest.raises(QueryError):
            store.update_query(bad, {"v": 1})
    assert query(PAIR).to_df(store).count() == 2


def test_views_of_a_statement_don_t_stay(store, spark):
    spark.range(3).createOrReplaceTempView("mine")
    store.insert(PAIR, {"a": 1, "b": "x"})
    assert store.query("SELECT count(*) AS n FROM mine JOIN other", tables={"mine": PAIR, "other": PAIR}).head()["n"] == 1
    assert spark.table("mine").count() == 3
    assert not any(t.name == "other" for t in spark.catalog.listTables())
    spark.catalog.dropTempView("mine")


def test_migrate_write_and_read_by_one_repository(spark):
    spark.sql("DROP TABLE IF EXISTS many_types")
    repo = CatalogStore(spark)
    migrations.setup(repo, [MANY])
    made = repo.bulk_insert(MANY, [{"tags": ["a"], "created": dt.date(2024, m, 3), "balance": "1.5"} for m in (1, 1, 2)], batch_size=2)
    assert len(made) == 3
    assert sorted((r["created"].month, r["age"], r["made"]) for r in query(MANY).run(repo)) == [(1, 42, 1), (1, 42, 1), (2, 42, 1)]
    month = repo.scan_month(MANY, "202401")
    assert month.count() == 2
    assert "PartitionFilters: [isnotnull(p_created_yyyymm" in month._jdf.queryExecution().toString()
    wider = Resource("many_types", (*MANY.attributes, Attribute("extra", "integer")), partition_by=MANY.partition_by, indexes=MANY.indexes)
    migrations.setup(repo, [wider])
    repo.insert(wider, {"tags": [], "created": dt.date(2024, 3, 1), "extra": 5})
    assert sorted(str(r["extra"]) for r in query(wider).run(repo)) == ["5", "None", "None", "None"]
    spark.sql("DROP TABLE many_types")


# ---- types


def test_logical_types(caplog):
    s = lambda *a: types.spark_type(*a).simpleString()
    assert [s(t) for t in ("uuid", "integer", "float", "boolean", "ci_string", "binary", "utc_datetime", "naive_datetime", "date", "time", "map", "list")] == [
        "string", "bigint", "double", "boolean", "string", "binary", "timestamp", "timestamp_ntz", "date", "string", "map<string,string>", "array<string>",
    ]
    assert s("decimal") == "decimal(38,10)"
    assert s("decimal", {"precision": 20, "scale": 6}) == "decimal(20,6)"
    assert s(("map", "string", ("array", "integer"))) == "map<string,array<bigint>>"
    assert s(("tuple", ["integer", "string"])) == "struct<_1:bigint,_2:string>"
    assert s(type("Own", (), {"subtype_of": staticmethod(lambda: "integer")})) == "bigint"
    assert s("mystery") == "string"
    assert "mystery" in caplog.text


@pytest.mark.parametrize(
    ("value", "kind", "want"),
    [
        ("12abc", "integer", 12), ("x", "integer", "x"), ("1.5kg", "float", 1.5), ("2.50 EUR", "decimal", decimal.Decimal("2.50")), ("true", "boolean", True), ("0", "boolean", False), (1, "boolean", True),
        ("maybe", "boolean", "maybe"), (b"\0" * 16, "uuid", "00000000-0000-0000-0000-000000000000"), ("2024-01-02", "date", dt.date(2024, 1, 2)), ("2024-01-02T00:00:00", "utc_datetime", dt.datetime(2024, 1, 2, tzinfo=dt.UTC)),
        (["1", 2], ("array", "integer"), [1, 2]), ({"a": "1"}, ("map", "string", "integer"), {"a": 1}), (None, "integer", None), (7, "string", "7"),
    ],
)
def test_decode(value, kind, want):
    assert types.decode(value, kind) == want


def test_decode_column(spark):
    rows = spark.createDataFrame([("12abc", "true"), ("x", "?"), (None, None)], "a string, b string")
    got = rows.select(types.decode_column(rows.a, "integer").alias("a"), types.decode_column(rows.b, "boolean").alias("b")).collect()
    assert [tuple(r) for r in got] == [(12, True), (None, None), (None, None)]


# ---- schema and DDL

MANY = Resource(
    "many_types",
    (
        Attribute("id", "uuid", primary_key=True), Attribute("name", nullable=False, default="it's"), Attribute("age", "integer", default=42), Attribute("score", "float", default=1.5), Attribute("active", "boolean", default=True),
        Attribute("tags", ("array", "string"), nullable=False), Attribute("balance", "decimal", constraints={"precision": 20, "scale": 6}), Attribute("created", "date", default=dt.date(2024, 1, 2)), Attribute("made", "integer", default=lambda: 1),
    ),
    partition_by="toYYYYMM(created)", indexes=(Index("by_name", "name", "bloom_filter"), Index("by_age", "age", "minmax", 4)), settings="index_granularity = 8192",
)


def test_schema_rules():
    assert Resource("App.Domain.UserAccount", ()).table_name == "user_account"
    assert Resource("App.Domain.UserAccount", (), domain="Domain").table_name == "domain_user_account"
    for bad in (dict(table="a-b"), dict(database="x;y"), dict(indexes=(Index("i", "x", "btree"),)), dict(indexes=(Index("i", "x"), Index("i", "y"))), dict(indexes=(Index("i", ""),)), dict(tenancy="row")):
        with pytest.raises(ConfigurationError):
            Resource("r", (), **bad)
    with pytest.raises(ConfigurationError):
        Resource("r", (Attribute("tags", "list"),)).check_nullability()
    with pytest.raises(ConfigurationError):
        Relationship("x", "many_to_many", PAIR, "a", "a")
    assert identifiers.quoted("a`b") == "`a``b`"
    assert identifiers.sanitized("a-b;c") == "abc"
    assert MANY.layout_keys == ("id",)


def test_create_table_and_evolve(spark):
    repo = CatalogRepo(spark)
    spark.sql("DROP TABLE IF EXISTS many_types")
    statements = ddl.pending(spark, MANY)
    assert len(statements) == 1
    assert "DEFAULT 'it\\'s'" in statements[0]
    assert "`made` BIGINT" in statements[0]
    assert "`made` BIGINT DEFAULT" not in statements[0]
    repo.query(statements[0])
    assert repo.exists(MANY)
    assert ddl.pending(spark, MANY) == []
    wider = Resource("many_types", (*MANY.attributes, Attribute("extra", "integer")), partition_by=MANY.partition_by, indexes=(*MANY.indexes, Index("by_extra", "extra", "set")))
    added = ddl.pending(spark, wider)
    assert len(added) == 2
    for s in added:
        repo.query(s)
    assert ddl.pending(spark, wider) == []
    assert query(wider).run(repo) == []
    assert ddl.reverse(statements[0]).startswith("DROP TABLE IF EXISTS")
    assert ddl.reverse(added[0]) is None, "these tables can't drop a column"
    assert ddl.reverse(added[1]).startswith("ALTER TABLE `many_types` UNSET TBLPROPERTIES")
    assert ddl.reverse("INSERT INTO x VALUES (1)") is None
    drifted = Resource("many_types", wider.attributes, indexes=(Index("by_age", "age", "set"),))
    assert ddl.add_indexes(drifted, {"tessera.index.by_age": "age TYPE minmax GRANULARITY 4"})[1]
    spark.sql("DROP TABLE many_types")


def test_migrations(spark, store, tmp_path):
    repo = CatalogRepo(spark)
    m = lambda v, t: migrations.Migration(v, lambda: [f"CREATE TABLE IF NOT EXISTS {t} (a INT) USING parquet"])
    run = migrations.Runner(repo, store, [m("10", "mig_b"), m("9", "mig_a"), migrations.Migration("11", lambda: ["SELECT 1"])])
    assert run.migrate(dry_run=True) == ["9", "10", "11"]
    assert run.applied() == []
    assert run.migrate() == ["9", "10", "11"]
    assert run.migrate() == []
    assert run.rollback("9") == ["10"], "what can't be taken back is left"
    assert spark.catalog.tableExists("mig_a")
    assert not spark.catalog.tableExists("mig_b")
    with pytest.raises(QueryError):
        run.rollback(object())
    assert run.rollback() == ["9"]
    failing = migrations.Runner(repo, store, [m("20", "mig_c"), migrations.Migration("21", lambda: ["SELEC 1"]), m("22", "mig_d")])
    with pytest.raises(QueryError):
        failing.migrate()
    assert "20" in failing.applied()
    assert "22" not in failing.applied()
    failing.rollback()


def test_generation(tmp_path):
    folder, shots = tmp_path / "m", tmp_path / "s"
    assert migrations.generate([MANY], shots, folder, "20240101000000", "dry_run")
    assert not shots.exists()
    with pytest.raises(ConfigurationError):
        migrations.generate([MANY], shots, folder, "20240101000000", "check")
    migrations.generate([MANY], shots, folder, "20240101000000")
    assert migrations.generate([MANY], shots, folder, "20240102000000", "check") == []
    wider = Resource("many_types", (*MANY.attributes, Attribute("extra", "integer")), partition_by=MANY.partition_by, indexes=MANY.indexes)
    assert len(migrations.generate([wider], shots, folder, "20240102000000")) == 1
    found = migrations.discover(folder)
    assert [x.version for x in found] == ["20240101000000", "20240102000000"]
    assert found[0].reversal() == ["DROP TABLE IF EXISTS `many_types`"]
    assert migrations.generate([Resource("archived", (), migrate=False)], shots, folder, "3") == []


def test_setup_goes_on_after_a_failure(spark):
    repo = CatalogRepo(spark)
    bad = Resource("bad_one", (Attribute("tags", "list"),))
    good = Resource("good_one", (Attribute("id", "integer", primary_key=True),))
    found = migrations.setup(repo, [bad, good])
    assert found["bad_one"].startswith("error")
    assert repo.exists(good)
    spark.sql("DROP TABLE good_one")
