"""Per-record calculations, applied in declared order inside the plan."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.types import spark_type

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Calculation:
    """``how``: a Column, a function of the frame that returns one, or an object with ``calculate(records, options)``.

    Objects get a pandas frame of the ``needs`` columns a batch at a time and return one value per record, of
    logical type ``type``.
    """

    name: str
    how: Any
    type: Any = "string"
    needs: tuple[str, ...] = ()
    options: dict[str, Any] = field(default_factory=dict)


def apply(records: DataFrame, calculations: list[Calculation]) -> DataFrame:
    """``records`` with a column for each calculation; one that can't be applied is skipped with a warning."""
    for c in calculations:
        column = _column(records, c)
        if column is None:
            log.warning("calculation %s is not supported; records are left as they are", c.name)
        else:
            records = records.withColumn(c.name, column)
    return records


def _column(records: DataFrame, c: Calculation) -> Column | None:
    if isinstance(c.how, Column):
        return c.how
    if callable(module := getattr(c.how, "calculate", None)):
        return _by_module(module, c, records)
    if isinstance(c.how, Callable):
        found = c.how(records)
        return found if isinstance(found, Column) else None
    return None


def _by_module(calculate: Callable, c: Calculation, records: DataFrame) -> Column:
    names, options = c.needs or tuple(records.columns), c.options

    def batch(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(list(calculate(rows.set_axis(list(names), axis=1), options)))

    return F.pandas_udf(batch, spark_type(c.type))(F.struct(*names))
