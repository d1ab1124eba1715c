"""The registered queries over the given tables, and the SQL of each."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.config import Config, work_folder
from tessera.functions.predicates import attr
from tessera.operators.aggregates import Aggregate
from tessera.operators.calculations import Calculation
from tessera.plans.migrations import setup
from tessera.plans.query import Query, query
from tessera.schema import Attribute, Relationship, Resource
from tessera.sources.repo import ParquetRepo
from tessera.sources.store import CatalogStore, StoreRepo

_INT, _BIG, _REAL, _TEXT, _NTZ = T.IntegerType(), "integer", "double", "string", "naive_datetime"


def _resource(name: str, columns: dict, keys: tuple[str, ...] = (), **options) -> Resource:
    return Resource(name, tuple(Attribute(c, t, primary_key=c in keys) for c, t in columns.items()), **options)


REGION = _resource("region", {"r_regionkey": _INT, "r_name": _TEXT}, ("r_regionkey",))
NATION = _resource("nation", {"n_nationkey": _INT, "n_name": _TEXT, "n_regionkey": _INT}, ("n_nationkey",), relationships=(Relationship("region", "belongs_to", REGION, "n_regionkey", "r_regionkey"),))
CUSTOMER = _resource(
    "customer", {"c_custkey": _BIG, "c_name": _TEXT, "c_nationkey": _INT, "c_acctbal": _REAL, "c_mktsegment": _TEXT}, ("c_custkey",),
    relationships=(Relationship("orders", "has_many", lambda: ORDERS, "c_custkey", "o_custkey"),),
)
SUPPLIER = _resource("supplier", {"s_suppkey": _BIG, "s_name": _TEXT, "s_nationkey": _INT, "s_acctbal": _REAL}, ("s_suppkey",))
PART = _resource("part", {"p_partkey": _BIG, "p_name": _TEXT, "p_brand": _TEXT, "p_type": _TEXT, "p_size": _INT, "p_retailprice": _REAL}, ("p_partkey",))
_ORDERS = {"o_orderkey": _BIG, "o_custkey": _BIG, "o_orderstatus": _TEXT, "o_totalprice": _REAL, "o_orderdate": _NTZ, "o_orderpriority": _TEXT}
ORDERS = _resource("orders", _ORDERS, ("o_orderkey",), relationships=(Relationship("customer", "belongs_to", CUSTOMER, "o_custkey", "c_custkey"),))
OPEN_ORDERS = _resource("open_orders", _ORDERS, ("o_orderkey",), table="orders", base_filter=attr("o_orderstatus") == "O")
LINEITEM = _resource(
    "lineitem",
    {"l_orderkey": _BIG, "l_partkey": _BIG, "l_suppkey": _BIG, "l_linenumber": _INT, "l_quantity": _REAL, "l_extendedprice": _REAL, "l_discount": _REAL, "l_tax": _REAL, "l_returnflag": _TEXT, "l_linestatus": _TEXT, "l_shipdate": _NTZ},
)
EVENTS = _resource("events", {"event_id": _BIG, "ts": _NTZ, "user_id": _BIG, "event_type": _TEXT, "value": _REAL, "props": _TEXT}, ("event_id",), tenancy="attribute", tenant_attribute="user_id")
LABELS = _resource("labels", {"doc_id": _BIG, "quality": _INT, "toxic": _INT}, ("doc_id",))
DOCUMENTS = _resource("documents", {"doc_id": _BIG, "text": _TEXT, "lang": _TEXT, "source": _TEXT, "n_chars": _BIG}, ("doc_id",), relationships=(Relationship("label", "has_one", LABELS, "doc_id", "doc_id"),))
EMBEDDINGS = _resource("embeddings", {"vec_id": _BIG, "embedding": T.ArrayType(T.FloatType()), "label": _INT}, ("vec_id",))
CONVERSATIONS = _resource("conversations", {"conv_id": _BIG, "turn": _BIG, "role": _TEXT, "text": _TEXT}, ("conv_id", "turn"))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _register(name: str, sql: str, resource: Resource | None = None):
    """Registers a function of a query (of ``resource``) or of (spark, sf_dir), and its SQL."""

    def add(f):
        QUERIES[name] = (lambda spark, sf_dir: f(query(resource)).to_df(ParquetRepo(spark, sf_dir))) if resource else f
        ORACLE_SQL[name] = sql
        return f

    return add


def _simple(name: str, resource: Resource, build: Callable[[Query], Query], sql: str) -> None:
    _register(name, sql, resource)(build)


def _values(name: str, resource: Resource, aggregates: tuple[Aggregate, ...], sql: str, build: Callable[[Query], Query] = lambda q: q) -> None:
    """A query of aggregates over the filtered rows."""
    QUERIES[name] = lambda spark, sf_dir: build(query(resource)).aggregate_df(ParquetRepo(spark, sf_dir), *aggregates)
    ORACLE_SQL[name] = sql


def _rounded(name: str, digits: dict[str, int]) -> None:
    """Sums of doubles depend on the order of addition, so their last digits are rounded off."""
    inner = QUERIES[name]
    QUERIES[name] = lambda spark, sf_dir: (lambda df: df.withColumns({c: F.round(c, n) for c, n in digits.items()}))(inner(spark, sf_dir))


a = attr
_simple(
    "Q01_filter_sort_page", ORDERS,
    lambda q: q.filter(a("o_orderstatus") == "F", a("o_totalprice") >= 1000).select("o_orderkey", "o_custkey", "o_totalprice").sort(("o_totalprice", "desc"), "o_orderkey").offset(10).limit(20),
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 1000 ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST LIMIT 20 OFFSET 10",
)
_simple("Q02_or", ORDERS, lambda q: q.filter((a("o_orderstatus") == "P") | (a("o_totalprice") > 400000) | (a("o_orderkey") == 1)).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' OR o_totalprice > 400000 OR o_orderkey = 1")
_simple("Q03_not", CUSTOMER, lambda q: q.filter(~(a("c_acctbal") < 0)).select("c_custkey"), "SELECT c_custkey FROM customer WHERE NOT (c_acctbal < 0)")
_simple(
    "Q04_nested_bool", PART,
    lambda q: q.filter(((a("p_size") == 1) & ((a("p_type") == "ECONOMY") | ~(a("p_retailprice") > 1000))) | (a("p_size") > 45)).select("p_partkey"),
    "SELECT p_partkey FROM part WHERE (p_size = 1 AND (p_type = 'ECONOMY' OR NOT (p_retailprice > 1000))) OR p_size > 45",
)
_simple("Q05_not_eq", ORDERS, lambda q: q.filter(("o_orderstatus", "!=", "O")).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'")
_simple("Q06_gt", LINEITEM, lambda q: q.filter(a("l_quantity") > 45).select("l_orderkey", "l_partkey", "l_quantity"), "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45")
_simple("Q07_lt", SUPPLIER, lambda q: q.filter(a("s_acctbal") < 5000).select("s_suppkey", "s_acctbal"), "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < 5000")
_simple("Q08_le_date", ORDERS, lambda q: q.filter(a("o_orderdate") <= dt.datetime(1996, 1, 1)).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderdate <= TIMESTAMP '1996-01-01'")
_simple("Q09_in", CUSTOMER, lambda q: q.filter(a("c_mktsegment").is_in(["AUTOMOBILE", "MACHINERY"])).select("c_custkey", "c_mktsegment"), "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'MACHINERY')")
_simple("Q10_not_in", CUSTOMER, lambda q: q.filter(a("c_mktsegment").not_in(["AUTOMOBILE", "MACHINERY"])).select("c_custkey"), "SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'MACHINERY')")
_values("Q11_empty_in", CUSTOMER, (Aggregate("n", "count"),), "SELECT count(*) AS n FROM customer WHERE FALSE", lambda q: q.filter(a("c_custkey").is_in([])))
_values("Q12_empty_not_in", CUSTOMER, (Aggregate("n", "count"),), "SELECT count(*) AS n FROM customer WHERE TRUE", lambda q: q.filter(a("c_custkey").not_in([])))
_simple("Q13_contains_ci", PART, lambda q: q.filter(a("p_name").contains("RED")).select("p_partkey", "p_name"), "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), lower('RED'))")
_simple("Q15_like", PART, lambda q: q.filter(a("p_brand").like("Brand#1_")).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_brand LIKE 'Brand#1_'")
_simple("Q16_ilike", PART, lambda q: q.filter(a("p_type").ilike("eco%")).select("p_partkey"), "SELECT p_partkey FROM part WHERE p_type ILIKE 'eco%'")
_simple("Q17_prefix_suffix", PART, lambda q: q.filter(a("p_name").starts_with("blue"), a("p_name").ends_with("bolt")).select("p_partkey"), "SELECT p_partkey FROM part WHERE starts_with(p_name, 'blue') AND ends_with(p_name, 'bolt')")
_values(
    "Q18_is_nil", CUSTOMER, (Aggregate("nulls", "count", filter=a("c_name").is_nil()), Aggregate("present", "count", filter=a("c_name").is_nil(False))),
    "SELECT count(*) FILTER (WHERE c_name IS NULL) AS nulls, count(*) FILTER (WHERE c_name IS NOT NULL) AS present FROM customer",
)
_values("Q19_count_star", ORDERS, (Aggregate("cnt", "count"),), "SELECT count(*) AS cnt FROM orders WHERE o_orderstatus = 'F'", lambda q: q.filter(a("o_orderstatus") == "F"))
_values("Q20_count_field", ORDERS, (Aggregate("cnt", "count", "o_custkey"),), "SELECT count(o_custkey) AS cnt FROM orders")
_values("Q21_sum", LINEITEM, (Aggregate("sum_ln", "sum", "l_linenumber"), Aggregate("sum_qty", "sum", "l_quantity")), "SELECT CAST(sum(l_linenumber) AS BIGINT) AS sum_ln, round(sum(l_quantity), 2) AS sum_qty FROM lineitem")
_rounded("Q21_sum", {"sum_qty": 2})
_values("Q22_avg", LINEITEM, (Aggregate("avg_ln", "avg", "l_linenumber"),), "SELECT round(avg(l_linenumber), 6) AS avg_ln FROM lineitem")
_rounded("Q22_avg", {"avg_ln": 6})
_values(
    "Q23_min_max", ORDERS, (Aggregate("mn", "min", "o_totalprice"), Aggregate("mx", "max", "o_totalprice"), Aggregate("d0", "min", "o_orderdate"), Aggregate("p1", "max", "o_orderpriority")),
    "SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx, min(o_orderdate) AS d0, max(o_orderpriority) AS p1 FROM orders",
)
_simple("Q24_group_by", LINEITEM, lambda q: q.group_by("l_returnflag", "l_linestatus", aggregates=(Aggregate("cnt", "count"),)), "SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_linestatus")
_values(
    "Q25_filtered_agg", CUSTOMER, (Aggregate("total_count", "count"), Aggregate("rich_count", "count", filter=a("c_acctbal") >= 5000)),
    "SELECT count(*) AS total_count, count(*) FILTER (WHERE c_acctbal >= 5000) AS rich_count FROM customer",
)
_simple("Q26_distinct", CUSTOMER, lambda q: q.distinct("c_mktsegment"), "SELECT DISTINCT c_mktsegment FROM customer")
_simple("Q27_distinct_select", ORDERS, lambda q: q.select("o_orderstatus").distinct("o_orderpriority"), "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
_simple("Q28_distinct_hidden_sort", ORDERS, lambda q: q.distinct("o_orderstatus").sort("o_orderpriority"), "SELECT o_orderstatus FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders)")
_simple("Q29_nulls_first", CUSTOMER, lambda q: q.select("c_custkey").sort(("c_acctbal", "asc_nils_first"), "c_custkey").limit(25), "SELECT c_custkey FROM customer ORDER BY c_acctbal ASC NULLS FIRST, c_custkey LIMIT 25")
_simple("Q30_offset_only", ORDERS, lambda q: q.select("o_orderkey").sort("o_orderkey").offset(14000), "SELECT o_orderkey FROM orders ORDER BY o_orderkey OFFSET 14000")
_simple(
    "Q31_has_many_count", CUSTOMER, lambda q: q.select("c_custkey").aggregate(Aggregate("order_count", "count", "o_orderkey", ("orders",), default=0)),
    "SELECT c_custkey, coalesce(n, 0) AS order_count FROM customer LEFT JOIN (SELECT o_custkey, count(o_orderkey) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey",
)
_simple(
    "Q32_has_many_sum", CUSTOMER, lambda q: q.select("c_custkey").aggregate(Aggregate("order_total", "sum", "o_totalprice", ("orders",), default=0.0)),
    "SELECT c_custkey, round(coalesce(s, 0), 2) AS order_total FROM customer LEFT JOIN (SELECT o_custkey, sum(o_totalprice) AS s FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey",
)
_rounded("Q32_has_many_sum", {"order_total": 2})
_simple(
    "Q33_has_one", DOCUMENTS, lambda q: q.select("doc_id").aggregate(Aggregate("quality", "max", "quality", ("label",), default=-1)),
    "SELECT d.doc_id, coalesce(q, -1) AS quality FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id",
)
_simple("Q34_belongs_to", ORDERS, lambda q: q.select("o_orderkey").aggregate(Aggregate("customer_acctbal", "max", "c_acctbal", ("customer",))), "SELECT o_orderkey, c_acctbal AS customer_acctbal FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
_simple("Q35_same_table", ORDERS, lambda q: q.select("o_orderkey").aggregate(Aggregate("s", "sum", "o_totalprice")), "SELECT o_orderkey, round(sum(o_totalprice), 2) AS s FROM orders GROUP BY o_orderkey")
_rounded("Q35_same_table", {"s": 2})
_simple("Q36_tenant", EVENTS, lambda q: q.set_tenant(7).select("event_id", "event_type"), "SELECT event_id, event_type FROM events WHERE user_id = 7")
_simple("Q37_base_filter", OPEN_ORDERS, lambda q: q.filter(a("o_totalprice") > 1000).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 1000")
_simple(
    "Q38_calculation", LINEITEM, lambda q: q.select("l_orderkey", "l_partkey", "l_suppkey").calculate(Calculation("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))),
    "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem",
)
_simple("Q40_array_column", EMBEDDINGS, lambda q: q.filter(a("label") == 1).select("vec_id").calculate(Calculation("dim", lambda rows: F.size("embedding"))), "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim FROM embeddings WHERE label = 1")
_simple(
    "Q44_has_many_default", DOCUMENTS, lambda q: q.select("doc_id").aggregate(Aggregate("label_count", "count", "doc_id", ("label",), default=0)),
    "SELECT d.doc_id, coalesce(n, 0) AS label_count FROM documents d LEFT JOIN (SELECT doc_id, count(doc_id) AS n FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id",
)
_simple(
    "Q45_composite_page", CONVERSATIONS, lambda q: q.select("conv_id", "turn", "role").sort(("role", "desc")).page(50, 100),
    "SELECT conv_id, turn, role FROM conversations ORDER BY role DESC NULLS LAST, conv_id, turn LIMIT 50 OFFSET 100",
)
_simple(
    "Q46_belongs_to_region", NATION, lambda q: q.select("n_nationkey", "n_name").aggregate(Aggregate("region_name", "min", "r_name", ("region",))),
    "SELECT n_nationkey, n_name, r_name AS region_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
)
_simple(
    "Q47_related_filter", CUSTOMER, lambda q: q.select("c_custkey").aggregate(Aggregate("big_orders", "count", path=("orders",), filter=a("o_totalprice") > 200000, default=0), Aggregate("last_order", "max", "o_orderdate", ("orders",))),
    "SELECT c_custkey, coalesce(n, 0) AS big_orders, d AS last_order FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (WHERE o_totalprice > 200000) AS n, max(o_orderdate) AS d FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey",
)


@_register("Q14_contains_cs", "SELECT p_partkey FROM part WHERE contains(p_name, 'ing')")
def _contains_cs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return query(PART).filter(a("p_name").contains("ing")).select("p_partkey").to_df(ParquetRepo(spark, sf_dir, Config(contains_case_sensitive=True)))


@_register("Q39_raw_sql", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderstatus")
def _raw_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ParquetRepo(spark, sf_dir).query("SELECT o_orderstatus, count(*) AS n FROM raw_orders WHERE o_totalprice > ? GROUP BY o_orderstatus", [1000], {"raw_orders": ORDERS})


def _store(spark: SparkSession, sf_dir: str, resource: Resource) -> StoreRepo:
    """A new store that holds the resource's rows."""
    store = StoreRepo(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    store.insert_frame(resource, ParquetRepo(spark, sf_dir).scan(resource))
    return store


@_register("Q41_bulk_create", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT CAST(100 AS INTEGER), 'NEW' FROM range(1)")
def _bulk_create(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, REGION)
    store.bulk_insert(REGION, [{"r_regionkey": 100, "r_name": "NEW"}])
    return query(REGION).to_df(store)


@_register("Q42_update_query", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer")
def _update_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, CUSTOMER)
    store.update_query(query(CUSTOMER).filter(a("c_acctbal") < 0), {"c_acctbal": 0.0})
    return query(CUSTOMER).select("c_custkey", "c_acctbal").to_df(store)


@_register("Q43_destroy_query", "SELECT o_orderkey FROM orders WHERE NOT coalesce(o_orderstatus = 'P', FALSE)")
def _destroy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, ORDERS)
    store.destroy_query(query(ORDERS).filter(a("o_orderstatus") == "P"))
    return query(ORDERS).select("o_orderkey").to_df(store)


# ---- operators that have no query above


@dataclass(frozen=True)
class _Brackets:
    """A calculation by a module: in batches, over the columns that it needs."""

    def calculate(self, records, options):
        return (records["c_acctbal"] // options["width"]).astype("int64")


_simple("Q48_module_calculation", CUSTOMER, lambda q: q.select("c_custkey").calculate(Calculation("bracket", _Brackets(), "integer", ("c_acctbal",), {"width": 1000})), "SELECT c_custkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS bracket FROM customer")
_simple("Q49_calculation_after_calculation", PART, lambda q: q.select("p_partkey").calculate(Calculation("half", F.col("p_size") * 2), Calculation("more", F.col("half") + 1)), "SELECT p_partkey, p_size * 2 AS half, p_size * 2 + 1 AS more FROM part")
_simple("Q50_sorts_stack", ORDERS, lambda q: q.select("o_orderkey").sort("o_orderkey").sort(("o_orderstatus", "desc")).limit(40), "SELECT o_orderkey FROM orders ORDER BY o_orderstatus DESC NULLS LAST, o_orderkey LIMIT 40")
_simple("Q51_filters_stack", ORDERS, lambda q: q.filter(a("o_orderstatus") == "F").filter(a("o_totalprice") < 50000, {"o_orderpriority": "1-URGENT"}).select("o_orderkey"), "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice < 50000 AND o_orderpriority = '1-URGENT'")
_simple("Q52_distinct_rows", LABELS, lambda q: q.select("quality", "toxic").distinct(), "SELECT DISTINCT quality, toxic FROM labels")
_simple("Q53_default_tenant", replace(EVENTS, default_context={"tenant": 3}), lambda q: q.select("event_id"), "SELECT event_id FROM events WHERE user_id = 3")
_simple(
    "Q54_page_of_related", CUSTOMER, lambda q: q.filter(a("c_acctbal") > 0).select("c_custkey").sort(("c_acctbal", "desc")).page(20).aggregate(Aggregate("n", "count", path=("orders",), default=0), Aggregate("low", "min", "o_totalprice", ("orders",))),
    "SELECT c_custkey, coalesce(n, 0) AS n, low FROM (SELECT c_custkey FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 20) LEFT JOIN (SELECT o_custkey, count(*) AS n, min(o_totalprice) AS low FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey",
)
_simple("Q55_several_hops", NATION, lambda q: q.select("n_nationkey").aggregate(Aggregate("deep", "count", path=("region", "nations"), default=-1)), "SELECT n_nationkey, CAST(-1 AS INTEGER) AS deep FROM nation")
_values("Q56_aggregate_default", ORDERS, (Aggregate("none", "max", "o_custkey", default=0), Aggregate("n", "count")), "SELECT coalesce(max(o_custkey), CAST(0 AS BIGINT)) AS none, count(*) AS n FROM orders WHERE o_orderstatus = 'none'", lambda q: q.filter(a("o_orderstatus") == "none"))
_values("Q57_aggregates_ignore_pages", CUSTOMER, (Aggregate("n", "count"), Aggregate("top", "max", "c_acctbal")), "SELECT count(*) AS n, max(c_acctbal) AS top FROM customer", lambda q: q.sort("c_name").limit(3).offset(2))
_simple("Q58_group_aggregates", ORDERS, lambda q: q.filter(a("o_totalprice") > 1000).group_by("o_orderpriority", aggregates=(Aggregate("n", "count"), Aggregate("first", "min", "o_orderdate"), Aggregate("open", "count", filter=a("o_orderstatus") == "O"))), "SELECT o_orderpriority, count(*) AS n, min(o_orderdate) AS first, count(*) FILTER (WHERE o_orderstatus = 'O') AS open FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderpriority")
_simple("Q59_tenant_in_context", EVENTS, lambda q: q.set_context({"actor": "a"}).set_tenant(5).filter(a("value") > 0).select("event_id", "value"), "SELECT event_id, value FROM events WHERE user_id = 5 AND value > 0")
_simple("Q60_lock_reads_all", REGION, lambda q: q.lock("for_update").select("r_regionkey"), "SELECT r_regionkey FROM region")


@_register("Q61_lenient_filters", "SELECT c_custkey FROM customer WHERE c_acctbal > 5000")
def _lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An operator that can't be translated is dropped where that is configured."""
    repo = ParquetRepo(spark, sf_dir, Config(raise_on_untranslatable_filter=False))
    return query(CUSTOMER).filter(a("c_acctbal") > 5000, ("c_name", "no_such_operator", 1)).select("c_custkey").to_df(repo)


@_register("Q62_generated_keys", "SELECT n_name, CAST(36 AS INTEGER) AS key_length FROM nation")
def _generated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key get a UUID each."""
    named = _resource("named", {"id": "uuid", "n_name": _TEXT}, ("id",))
    store = StoreRepo(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    store.insert_frame(named, ParquetRepo(spark, sf_dir).scan(NATION).select("n_name"))
    return store.scan(named).where(F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).select("n_name", F.length("id").alias("key_length"))


@_register("Q63_uuid_filter", "SELECT CAST(7 AS BIGINT) AS c_custkey FROM range(1)")
def _uuid_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers match whatever their case on insert or in the filter."""
    keyed = _resource("keyed", {"id": "uuid", "c_custkey": _BIG}, ("id",))
    store = StoreRepo(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    text = F.format_string("%032X", F.col("c_custkey"))
    store.insert_frame(keyed, ParquetRepo(spark, sf_dir).scan(CUSTOMER).select(text.alias("id"), "c_custkey"))
    return query(keyed).filter(a("id") == uuid.UUID(int=7)).select("c_custkey").to_df(store)


@_register("Q64_update_record", "SELECT s_suppkey, CASE WHEN s_suppkey = 3 THEN 'renamed' ELSE s_name END AS s_name, CASE WHEN s_suppkey = 3 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier WHERE s_suppkey <> 4")
def _update_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, sf_dir, SUPPLIER)
    store.update(SUPPLIER, {"s_suppkey": 3}, {"s_name": "renamed", "s_acctbal": None})
    store.destroy(SUPPLIER, {"s_suppkey": 4})
    return query(SUPPLIER).select("s_suppkey", "s_name", "s_acctbal").to_df(store)


@_register("Q65_insert_defaults", "SELECT r_regionkey, r_name, 'new' AS state FROM region")
def _insert_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that the frame lacks takes its default."""
    stated = Resource("stated", (*REGION.attributes, Attribute("state", default="new")))
    store = StoreRepo(spark, f"{work_folder(spark)}/store-{uuid.uuid4().hex}")
    store.insert_frame(stated, ParquetRepo(spark, sf_dir).scan(REGION))
    return query(stated).to_df(store)


def _migrated(spark: SparkSession, resource: Resource) -> CatalogStore:
    store = CatalogStore(spark)
    failed = [x for x in setup(store, [resource]).values() if isinstance(x, str)]
    if failed:
        raise RuntimeError(failed[0])
    return store


@_register("Q66_migrate_write_prune", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1995-04-01'")
def _migrate_write_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migrated table partitioned by month: written through the repository, one month read back."""
    dated = replace(ORDERS, name=f"orders_{uuid.uuid4().hex}", partition_by="toYYYYMM(o_orderdate)", relationships=())
    store = _migrated(spark, dated)
    # one task writes a month
    store.insert_frame(dated, ParquetRepo(spark, sf_dir).scan(ORDERS).repartition(F.date_format("o_orderdate", "yyyyMM")))
    return store.scan_month(dated, "199503").select("o_orderkey", "o_totalprice")


@_register("Q67_evolve_by_adding", "SELECT n_nationkey, n_name, NULL::BIGINT AS people FROM nation UNION ALL SELECT CAST(1000 AS INTEGER), 'NEW', 5 FROM range(1)")
def _evolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column added to a table in use: old rows hold null."""
    old = _resource(f"nation_{uuid.uuid4().hex}", {"n_nationkey": _INT, "n_name": _TEXT}, ("n_nationkey",))
    _migrated(spark, old).insert_frame(old, ParquetRepo(spark, sf_dir).scan(NATION))
    new = replace(old, attributes=(*old.attributes, Attribute("people", _BIG)))
    store = _migrated(spark, new)
    store.bulk_insert(new, [{"n_nationkey": 1000, "n_name": "NEW", "people": "5 or so"}])
    return query(new).to_df(store)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Solvent customers with their orders' count and total, richest first, a page of them."""
    q = query(CUSTOMER).filter(a("c_acctbal") > 0).select("c_custkey", "c_name", "c_acctbal").sort(("c_acctbal", "desc")).page(20)
    return q.aggregate(Aggregate("order_count", "count", path=("orders",), default=0), Aggregate("order_total", "sum", "o_totalprice", ("orders",), default=0.0)).to_df(ParquetRepo(spark, sf_dir))
