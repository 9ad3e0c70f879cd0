"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each query reads the driver's tables (whole tables) and runs one operator of
the inventory; doubles are rounded to 6 digits for the engine comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadence.config import ORDERS_MAPPING
from cadence.plans.catalog_eval import evaluation_queries
from cadence.plans.catalog_features import target_feature_queries
from cadence.plans.catalog_models import model_queries
from cadence.plans.catalog_prep import full_frame, quality_split_queries, split_frame  # noqa: F401
from cadence.plans.catalog_report import report_queries
from cadence.plans.catalog_signals import signal_queries
from cadence.plans.common import mart, round_doubles

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for part in (target_feature_queries, quality_split_queries, evaluation_queries,
                 signal_queries, report_queries, model_queries):
        out.update(part())
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their labels and the 20 observation-window features."""
    return round_doubles(mart(spark, sf_dir, ORDERS_MAPPING))
