"""Registered label and feature queries (T-*, F-*) on the orders / events mappings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from cadence.config import EVENTS_MAPPING, ORDERS_MAPPING, CustomerMapping
from cadence.operators import targets as T
from cadence.operators.features import RFM_COLS, share_names
from cadence.plans.common import mart, round_doubles
from cadence.sources import customers, log_types, transactions

Query = Callable[[SparkSession, str], DataFrame]

LABEL_COLS = ["customer_id", "obs_count", "fut_count", "obs_monthly", "fut_monthly",
              "activity_ratio", "future_disengaged", "future_growth"]


def label_table(spark, d, m):
    """T3-T8 alone: one conditional-count aggregate joined to the spine."""
    return T.labels(customers(spark, d), transactions(spark, d, m), m.windows)


def _string_key_labels(spark, d):
    """T3-T8 with keys that are strings, by mappings (S-1, S-2)."""
    own = CustomerMapping("customer", "concat('C', c_custkey)", columns={})
    tx = transactions(spark, d, m := replace(ORDERS_MAPPING, customer_id="concat('C', o_custkey)"))
    return round_doubles(T.labels(customers(spark, d, own), tx, m.windows).select(*LABEL_COLS))


def _labels(m):
    return lambda spark, d: round_doubles(label_table(spark, d, m).select(*LABEL_COLS))


def _mart_cols(m, cols):
    return lambda spark, d: round_doubles(mart(spark, d, m, cols).select(*cols))


def _type_shares(m):
    """F-10: a share column for every type of the log."""
    def query(spark, d):
        shares = list(share_names(log_types(spark, d, m)).values())
        return round_doubles(mart(spark, d, m, shares).select("customer_id", *shares))
    return query


def _mart_all(m):
    return lambda spark, d: round_doubles(mart(spark, d, m))


def _class_dist(m, label):
    return lambda spark, d: T.class_distribution(label_table(spark, d, m), label)


def _base_rate(m, label):
    return lambda spark, d: round_doubles(T.base_rate(label_table(spark, d, m), label))


def target_feature_queries() -> dict[str, Query]:
    o, e = ORDERS_MAPPING, EVENTS_MAPPING
    return {
        "t_labels_orders": _labels(o),
        "t_labels_events": _labels(e),
        "s1_s2_string_key_labels": _string_key_labels,
        "t9_class_dist_disengaged": _class_dist(o, "future_disengaged"),
        "t9_class_dist_growth": _class_dist(o, "future_growth"),
        "t10_base_rate": _base_rate(o, "future_disengaged"),
        "f01_f09_rfm": _mart_cols(o, ["customer_id"] + RFM_COLS),
        "f10_type_shares": _type_shares(o),
        "f11_weekend_ratio": _mart_cols(o, ["customer_id", "tx_wknd_ratio"]),
        "f13_f14_trends": _mart_cols(o, ["customer_id", "tx_count_trend", "tx_amt_trend"]),
        "f15_max_gap": _mart_cols(o, ["customer_id", "tx_max_gap"]),
        "f16_late_ratio": _mart_cols(o, ["customer_id", "tx_late_ratio"]),
        "f18_mart_orders": _mart_all(o),
        "f18_mart_events": _mart_all(e),
    }
