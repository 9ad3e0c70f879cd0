"""Registered evaluation queries (E-*, H-1, H-2) on stand-in scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.operators import evaluate as E
from cadence.plans.common import round_doubles
from cadence.plans.standins import STANDIN_NEEDS, with_standins
from cadence.session import materialize
from cadence.sources import customers

LABEL = "future_disengaged"
WHAT_IF = 0.35


def scored_split(spark, d, split: str = "test", score: str = "s_recency") -> DataFrame:
    from cadence.plans.catalog_prep import split_frame
    s = with_standins(split_frame(spark, d, columns=STANDIN_NEEDS))
    return s.where(F.col("split") == split).select(
        "customer_id", F.col(LABEL).alias("label"), F.col(score).alias("score"))


def _events_rank(spark, d):
    """E-1 / E-2 on the events mapping over all customers: most scores tie at
    zero activity, a stress case for the tie handling."""
    from cadence.config import EVENTS_MAPPING
    from cadence.plans.common import mart
    s = with_standins(mart(spark, d, EVENTS_MAPPING, STANDIN_NEEDS))
    return E.rank_metrics(s.select("customer_id", F.col(LABEL).alias("label"),
                                   F.col("s_recency").alias("score")))


def _r(f):
    return lambda spark, d: round_doubles(f(spark, d))


def _grid(spark, d):
    from cadence.plans.catalog_prep import split_frame
    s = materialize(with_standins(split_frame(spark, d, columns=STANDIN_NEEDS)).where(F.col("split") == "test"))
    cols = {("Full", "recency"): "s_recency", ("Full", "gap"): "s_gap",
            ("Tx-strict", "recency"): "s_recency", ("Tx-strict", "freq"): "s_freq"}
    return E.evaluation_table({k: s.select("customer_id", F.col(LABEL).alias("label"),
                                           F.col(v).alias("score"))
                               for k, v in cols.items()})


def _report(spark, d):
    best = E.best_threshold(E.threshold_sweep(scored_split(spark, d, "val"))).first()["threshold"]
    return E.classification_report(scored_split(spark, d), best)


def _sanity(spark, d):
    return E.sanity_check(scored_split(spark, d), customers(spark, d))


def evaluation_queries():
    t = scored_split
    return {
        "e1_e2_rank_metrics": _r(lambda s, d: E.rank_metrics(t(s, d))),
        "e1_e2_rank_metrics_events": _r(_events_rank),
        "e3_brier": _r(lambda s, d: E.brier(t(s, d))),
        "e4_threshold_metrics": _r(lambda s, d: E.threshold_metrics(t(s, d), 0.5)),
        "e5_e6_top_decile": _r(lambda s, d: E.top_decile(t(s, d))),
        "e7_evaluation_table": _r(_grid),
        "e8_threshold_sweep": _r(lambda s, d: E.threshold_sweep(t(s, d, "val"))),
        "e9_best_threshold": _r(lambda s, d: E.best_threshold(E.threshold_sweep(t(s, d, "val")))),
        "e10_classification_report": _r(_report),
        "e11_confusion_matrix": lambda s, d: E.confusion_matrix(t(s, d), 0.5),
        "e12_what_if_threshold": _r(lambda s, d: E.threshold_metrics(t(s, d), WHAT_IF)),
        "e13_sanity_check": _r(_sanity),
        "e14_setup_comparison": _r(lambda s, d: E.setup_comparison(_grid(s, d))),
        "h1_roc_points": _r(lambda s, d: E.roc_points(t(s, d))),
        "h2_pr_points": _r(lambda s, d: E.pr_points(t(s, d))),
    }
