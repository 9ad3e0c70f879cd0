"""Deterministic stand-in scores derived from the data.

The signal, metric and report operators take any ``(customer_id, label,
score)`` or ``(customer_id, bp, rr, behaviour)`` frame. To check them exactly
against SQL, independent of MLlib, the registered queries feed them min-max
normalised behaviour columns of the orders mart (SURVEY section 5, items 5-6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators.signals import minmax_scale

STANDIN_SOURCES = {"s_recency": "tx_recency", "s_gap": "tx_max_gap", "s_late": "tx_late_ratio",
                   "s_freq": "tx_freq"}


# Behaviour columns the stand-in scores, signals and drill-down read.
STANDIN_NEEDS = ["tx_count", "tx_total", "tx_freq", "tx_recency", "tx_max_gap", "tx_count_trend",
                 "tx_late_ratio", "tx_wknd_ratio"]


def with_standins(mart: DataFrame) -> DataFrame:
    """Adds s_recency, s_gap, s_late, s_freq (min-max over all customers),
    ``rr_raw`` = s_recency and ``bp_raw`` = s_late."""
    base = mart
    for s, c in STANDIN_SOURCES.items():
        base = base.withColumn(s, F.col(c).cast("double"))
    out = minmax_scale(base, list(STANDIN_SOURCES))
    return out.withColumn("rr_raw", F.col("s_recency")).withColumn("bp_raw", F.col("s_late"))
