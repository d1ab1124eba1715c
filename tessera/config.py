"""Engine settings, and the folder for tables that the engine writes on its own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from tessera.errors import ConfigurationError


@dataclass(frozen=True)
class Config:
    """Fail-closed by default: what can't be translated or computed raises."""

    raise_on_untranslatable_filter: bool = True
    raise_on_aggregate_failure: bool = True
    contains_case_sensitive: bool = False
    strict_nullability: bool = True
    insert_batch: int = 1000
    insert_batch_most: int = 100_000


DEFAULT = Config()


def work_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the session names in ``spark.checkpoint.dir``."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise ConfigurationError("set spark.checkpoint.dir to a folder that driver and executors share; the engine's own tables go there")
    return found.rstrip("/")
