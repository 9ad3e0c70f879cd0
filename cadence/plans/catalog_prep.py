"""Registered quality, split and preprocessing queries (S-3, T1/T2, F-17/F-19, Q-*, P-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import EVENTS_MAPPING, ORDERS_MAPPING, CustomerMapping, FeatureSpec, SplitSpec
from cadence.operators import prep as P
from cadence.operators import quality as Q
from cadence.operators import split as S
from cadence.operators import targets as T
from cadence.operators.features import tx_feature_columns
from cadence.plans.common import mart, round_doubles
from cadence.session import materialize
from cadence.sources import customers, log_types, raw_transactions, read_table


def _key_profile(spark, d):
    return Q.key_profile(customers(spark, d), raw_transactions(spark, d, ORDERS_MAPPING))


def _events_enriched(spark, d):
    ev = read_table(spark, d, "events").groupBy(F.col("user_id").alias("customer_id")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return customers(spark, d).join(ev, "customer_id", "left")


def _null_profile(spark, d):
    return Q.null_profile(_events_enriched(spark, d))


def _orphans(m):
    return lambda spark, d: Q.orphan_counts(customers(spark, d), raw_transactions(spark, d, m))


def _clean_customers(spark, d):
    return Q.clean_customers(customers(spark, d), holdout=("sanity_score",))


#: The customer table under names of the exclusion lists, with a boolean.
LISTED = CustomerMapping("customer", "c_custkey", columns={
    "customer_segment": "c_mktsegment", "location": "c_name", "in_debt": "c_acctbal < 0", "balance": "c_acctbal",
    "churn_probability": "c_acctbal / 10000"}, sanity="c_nationkey")


def _clean_listed(spark, d):
    return round_doubles(Q.clean_customers(customers(spark, d, LISTED), holdout=("sanity_score",)))


def _sanity(spark, d):
    return round_doubles(Q.sanity_holdout(customers(spark, d), "sanity_score"))


def split_frame(spark, d, method="hash", columns=None):
    """Orders mart (optionally only ``columns`` features) with the 60/20/20
    split column."""
    return S.assign_split(mart(spark, d, ORDERS_MAPPING, columns), SplitSpec(),
                          label="future_disengaged", method=method)


def full_frame(spark, d):
    """Full setup rows: mart (features + labels + split) joined with the
    cleaned customer attributes (F-19 / J-3)."""
    cust = Q.clean_customers(customers(spark, d), holdout=("sanity_score",))
    return split_frame(spark, d).join(cust, "customer_id", "inner")


def _split(method):
    return lambda spark, d: split_frame(spark, d, method, columns=[]).select("customer_id", "split")


def _split_profile(spark, d):
    return round_doubles(S.split_profile(split_frame(spark, d, columns=[]), "future_disengaged"))


def _holdout(spark, d):
    return S.holdout_split(customers(spark, d).select("customer_id"), 42, 20)


def fit_full_preprocessor(df, types):
    spec = FeatureSpec()
    numeric = list(spec.numeric) + tx_feature_columns(types)
    return P.fit_preprocessor(df.where(F.col("split") == "train"), numeric,
                              dict(spec.ordinal), list(spec.nominal))


def _preprocess(spark, d):
    df = materialize(full_frame(spark, d))
    pre = fit_full_preprocessor(df, log_types(spark, d, ORDERS_MAPPING))
    return round_doubles(pre.transform(df, keep=["customer_id", "split"]))


def _profile(spark, d):
    from cadence.sources import table_profile
    return table_profile(raw_transactions(spark, d, ORDERS_MAPPING), "date")


def _source_profile(spark, d):
    """S-3 on both source tables with all their columns."""
    from cadence.sources import source_profile
    return source_profile(spark, d, ORDERS_MAPPING)


def _window_rows(spark, d):
    """T1 / T2: log rows in the observation and prediction windows."""
    w = ORDERS_MAPPING.windows
    tx = raw_transactions(spark, d, ORDERS_MAPPING)
    return tx.agg(F.count_if(T.in_obs(w)).alias("obs_rows"), F.count_if(T.in_pred(w)).alias("pred_rows"))


def _setup_rows(setup):
    """F-19: the rows of a feature setup, before preprocessing."""
    def query(spark, d):
        from cadence.plans.pipeline import setup_columns
        num, ordn, nom = setup_columns(setup, log_types(spark, d, ORDERS_MAPPING))
        return round_doubles(full_frame(spark, d).select("customer_id", *num, *ordn, *nom))
    return query


def quality_split_queries():
    return {
        "s3_table_profile": _profile,
        "s3_source_profile": _source_profile,
        "t1_t2_window_rows": _window_rows,
        "f19_tx_strict_rows": _setup_rows("Tx-strict"),
        "f19_cust_only_rows": _setup_rows("Cust-only"),
        "q1_q2_key_profile": _key_profile,
        "q3_null_profile": _null_profile,
        "q4_orphans_orders": _orphans(ORDERS_MAPPING),
        "q4_orphans_events": _orphans(EVENTS_MAPPING),
        "q5_q7_clean_customers": _clean_customers,
        "q5_q7_clean_listed": _clean_listed,
        "q8_sanity_holdout": _sanity,
        "p1_split_hash": _split("hash"),
        "p1_split_exact": _split("exact"),
        "p2_split_profile": _split_profile,
        "p3_holdout_split": _holdout,
        "p4_p9_preprocess_full": _preprocess,
    }
