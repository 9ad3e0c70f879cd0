"""Registered walk-forward, chart and report queries (V-*, H-3 ... H-7, R-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.config import ORDERS_FOLDS, ORDERS_FOLDS_START, ORDERS_MAPPING
from cadence.operators import evaluate as E
from cadence.operators import ranking as RK
from cadence.operators import report as R
from cadence.operators import walkforward as V
from cadence.operators.quality import clean_customers
from cadence.operators.split import hash_bucket
from cadence.plans.common import round_doubles
from cadence.session import materialize
from cadence.sources import customers, log_profile, log_types, transactions

BEHAVIOUR = RK.BEHAVIOUR_COLS


def _r(f):
    return lambda spark, d: round_doubles(f(spark, d))


def fold_frame(spark, d):
    m = ORDERS_MAPPING
    return V.fold_frame(spark, transactions(spark, d, m), customers(spark, d), ORDERS_FOLDS,
                        ORDERS_FOLDS_START, log_types(spark, d, m, max(f.obs_end for f in ORDERS_FOLDS)))


def full_fold_frame(spark, d):
    """V-2 with every transaction feature, five overlapping windows at once."""
    m = ORDERS_MAPPING
    types, heaviest = log_profile(spark, d, m, max(f.obs_end for f in ORDERS_FOLDS))
    return V.full_fold_frame(spark, transactions(spark, d, m), customers(spark, d), ORDERS_FOLDS,
                             ORDERS_FOLDS_START, types, heaviest=heaviest)


def _fold_table(spark, d):
    """V-1: fold configuration with the log rows each window covers."""
    m = ORDERS_MAPPING
    ft = V.fold_table(spark, ORDERS_FOLDS, ORDERS_FOLDS_START)
    tx = transactions(spark, d, m)
    j = tx.join(F.broadcast(ft), (F.col("date") >= F.col("obs_start")) & (F.col("date") < F.col("pred_end")))
    c = j.groupBy("fold").agg(
        F.count_if(F.col("date") < F.col("obs_end")).alias("obs_rows"),
        F.count_if(F.col("date") >= F.col("pred_start")).alias("pred_rows"))
    return ft.join(c, "fold", "left")


def fold_scores(spark, d):
    """Stand-in fold scores: min-max of recency within each fold (the fold
    min/max are a five-row table), on the fold's 80/20 hold-out test part."""
    ff = materialize(fold_frame(spark, d))
    mm = ff.groupBy("fold").agg(F.min("tx_recency").alias("_mn"), F.max("tx_recency").alias("_mx"))
    s = ff.join(F.broadcast(mm), "fold").withColumn(
        "score", F.when(F.col("_mx") - F.col("_mn") <= 0, F.lit(0.0)).otherwise(
            (F.col("tx_recency") - F.col("_mn")) / (F.col("_mx") - F.col("_mn"))))
    s = s.where(hash_bucket(F.col("customer_id"), 42) >= 80)
    return s.select("fold", "customer_id", F.col("future_disengaged").alias("label"), "score")


def fold_results(spark, d):
    """V-4 shape with the stand-in scorer: per fold ROC AUC, PR AUC, Brier."""
    s = materialize(fold_scores(spark, d))
    rk = E.rank_metrics(s, by=["fold"]).select("fold", "roc_auc", "pr_auc")
    br = s.groupBy("fold").agg(F.avg(F.pow(F.col("score") - F.col("label"), 2)).alias("brier"))
    return rk.join(br, "fold")


def _fold_labels(spark, d):
    ff = fold_frame(spark, d)
    return V.fold_labels_summary(ff, V.fold_table(spark, ORDERS_FOLDS, ORDERS_FOLDS_START))


def _signals(spark, d):
    from cadence.plans.catalog_signals import signals
    return signals(spark, d)


def _mart(spark, d, columns=None):
    from cadence.plans.catalog_prep import split_frame
    return split_frame(spark, d, columns=columns)


def _behaviour(spark, d):
    from cadence.plans.standins import STANDIN_NEEDS
    return _mart(spark, d, STANDIN_NEEDS)


def _class_hist(spark, d):
    return R.class_histograms(materialize(_behaviour(spark, d)), BEHAVIOUR, "future_disengaged", 30, 0.99)


def _attr_hist(spark, d):
    from cadence.plans.catalog_prep import full_frame
    return R.class_histograms(materialize(full_frame(spark, d)), ["c_acctbal", "c_nationkey"],
                              "future_disengaged", 30, None)


def _density(spark, d):
    from cadence.plans.catalog_eval import scored_split
    j = scored_split(spark, d).join(customers(spark, d).select("customer_id", "sanity_score"), "customer_id")
    return R.density_grid(j, "sanity_score", "score", 40)


def _kpis(spark, d):
    from cadence.plans.catalog_eval import _grid
    return R.headline_kpis(_grid(spark, d), fold_results(spark, d), _signals(spark, d))


def _run_summary(spark, d):
    from cadence.plans.catalog_eval import _grid
    grid = materialize(_grid(spark, d))
    return R.run_summary(_mart(spark, d, []), _signals(spark, d), grid, grid.where(F.col("setup") == "Tx-strict"))


def _dictionary(spark, d):
    return R.feature_dictionary(spark, _mart(spark, d), log_types(spark, d, ORDERS_MAPPING),
                                clean_customers(customers(spark, d), holdout=("sanity_score",)))


def _highlights(spark, d):
    from cadence.plans.catalog_eval import _grid
    return R.metric_highlights(_grid(spark, d))


def report_queries():
    return {
        "v1_fold_table": _fold_table,
        "v2_v3_fold_frame": _r(fold_frame),
        "v2_full_fold_frame": _r(full_fold_frame),
        "v4_fold_results_standin": _r(fold_results),
        "v5_fold_labels": _r(_fold_labels),
        "v6_v7_fold_stability": _r(lambda s, d: V.fold_stability(fold_results(s, d))),
        "h3_histogram_recency": _r(lambda s, d: R.histogram(_behaviour(s, d), "tx_recency", 30)),
        "h4_h7_class_histograms": _r(_class_hist),
        "h7_attribute_histograms": _r(_attr_hist),
        "h5_density_grid": _density,
        "h6_marker_size": _r(lambda s, d: R.marker_size(_signals(s, d), "expected_client_value").select(
            "customer_id", "marker_size")),
        "r1_headline_kpis": _r(_kpis),
        "r2_action_distribution": lambda s, d: R.action_distribution(_signals(s, d)),
        "r3_signal_means": _r(lambda s, d: R.signal_means(_signals(s, d))),
        "r4_correlation_matrix": _r(lambda s, d: R.correlation_matrix(_signals(s, d))),
        "r5_ecv_summary": _r(lambda s, d: R.ecv_summary(_signals(s, d))),
        "r6_frontier_summary": _r(lambda s, d: R.frontier_summary(_signals(s, d))),
        "r7_top100_total_ecv": _r(lambda s, d: R.top_ecv_total(RK.top_opportunities(_signals(s, d)))),
        "r8_run_summary": _r(_run_summary),
        "r9_metric_highlights": _r(_highlights),
        "r10_feature_dictionary": _r(_dictionary),
    }
