"""What the engine's queries can do, as a contract that callers may ask."""

from __future__ import annotations

from typing import Any

from tessera.functions.predicates import ALIASES, OPERATORS
from tessera.operators.aggregates import KINDS
from tessera.plans.query import ORDERS

#: The features that hold, and those that are declared absent.
FEATURES = (
    "create", "read", "update", "destroy", "filter", "limit", "offset", "select", "sort", "distinct", "multitenancy", "bulk_create", "update_query", "destroy_query", "stream", "calculate",
    "composite_primary_key", "nested_expressions", "boolean_filter", "async_engine", "changeset_filter", "action_select", "expression_calculation", "aggregate_filter",
)
ABSENT = (
    "combine", "join", "filter_relationship", "exists", "aggregate_relationship", "transact", "lock", "keyset", "upsert", "atomic", "expression_calculation_sort", "aggregate_sort", "update_many",
    "composite_type", "through_relationship", "bulk_create_with_partial_success", "bulk_upsert_return_skipped",
)


def can(feature: Any) -> bool:
    """``feature``: a name, or (kind, detail): an aggregate's kind, a filter's operator or a sort order."""
    match feature:
        case ("aggregate" | "query_aggregate", kind):
            return kind in KINDS
        case ("filter_expr", op):
            return ALIASES.get(op, op) in OPERATORS
        case ("sort", order):
            return order in ORDERS
    return feature in FEATURES
