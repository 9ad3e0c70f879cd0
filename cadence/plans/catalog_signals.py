"""Registered signal and ranking queries (G-*) on stand-in scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.operators import ranking as R
from cadence.operators import signals as G
from cadence.plans.common import round_doubles
from cadence.plans.standins import STANDIN_NEEDS, with_standins
from cadence.session import materialize


def standin_frame(spark, d):
    from cadence.plans.catalog_prep import split_frame
    return with_standins(split_frame(spark, d, columns=STANDIN_NEEDS))


def signals(spark, d):
    """Signal table of the stand-in scores, materialised once."""
    return materialize(G.signal_table(materialize(standin_frame(spark, d))))


def signals_events(spark, d):
    """The same signal chain on the events mapping (most customers inactive)."""
    from cadence.config import EVENTS_MAPPING
    from cadence.plans.common import mart
    return G.signal_table(materialize(with_standins(mart(spark, d, EVENTS_MAPPING, STANDIN_NEEDS))))


def _r(f):
    return lambda spark, d: round_doubles(f(spark, d))


def _minmax(spark, d):
    return standin_frame(spark, d).select("customer_id", "s_recency", "s_gap", "s_late", "s_freq")


def _engagement(spark, d):
    return G.engagement(standin_frame(spark, d)).select("customer_id", "engagement_raw")


def _drill(spark, d):
    from cadence.plans.catalog_prep import split_frame
    t = R.drilldown_table(signals(spark, d), split_frame(spark, d, columns=STANDIN_NEEDS))
    return t.select("client_id", F.explode("behaviour").alias("b")).select(
        "client_id", "b.feature", "b.value")


def _lookup(spark, d):
    """G-17 lookup of the client with the largest expected value."""
    from cadence.plans.catalog_prep import split_frame
    sig = signals(spark, d)
    top = R.top_opportunities(sig, 1).first()["customer_id"]
    return R.client_drilldown(sig, split_frame(spark, d, columns=STANDIN_NEEDS), str(top)).drop("behaviour")


def signal_queries():
    return {
        "g1_minmax_scale": _r(_minmax),
        "g2_engagement": _r(_engagement),
        "g1_g8_signal_table": _r(signals),
        "g1_g8_signal_table_events": _r(signals_events),
        "g5_formulation_corr": _r(lambda s, d: G.formulation_correlation(signals(s, d))),
        "g9_top_opportunities": _r(lambda s, d: R.top_opportunities(signals(s, d))),
        "g10_top_frontier": _r(lambda s, d: R.top_n(signals(s, d), "opportunity_frontier_score")),
        "g10_top_master": _r(lambda s, d: R.top_n(signals(s, d), "master_signal")),
        "g11_ranking_overlap": lambda s, d: R.ranking_overlap(signals(s, d)),
        "g12_hidden_gems": _r(lambda s, d: R.hidden_gems(signals(s, d))),
        "g13_product_score": _r(lambda s, d: G.product_score(signals(s, d)).select(
            "customer_id", "product_base_score")),
        "g14_product_quadrant": _r(lambda s, d: G.product_quadrant(signals(s, d))),
        "g15_strategic_segments": _r(lambda s, d: G.strategic_segments(signals(s, d))),
        "g16_frontier_zone": _r(lambda s, d: G.frontier_zone(signals(s, d))),
        "g17_drilldown_table": _drill,
        "g17_client_lookup": _r(_lookup),
        "g18_interpretation": lambda s, d: R.interpretation(signals(s, d)),
    }
