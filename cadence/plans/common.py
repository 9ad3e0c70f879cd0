"""Shared building blocks of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cadence.config import TxMapping
from cadence.operators.features import customer_mart
from cadence.sources import customers, log_profile, log_types, transactions


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns for an engine-independent comparison."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def mart(spark: SparkSession, sf_dir: str, m: TxMapping,
         columns: list[str] | None = None) -> DataFrame:
    """Feature mart with labels for a mapping (one row per customer). The log
    is read twice: for its types (and, for medians, its largest customer), and
    for the mart."""
    if columns is None or "tx_median" in columns:
        types, heaviest = log_profile(spark, sf_dir, m)
    else:
        types, heaviest = log_types(spark, sf_dir, m), None
    return customer_mart(customers(spark, sf_dir), transactions(spark, sf_dir, m),
                         m.windows, types, columns=columns, heaviest=heaviest)
