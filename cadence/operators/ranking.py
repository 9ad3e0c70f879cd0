"""Ranking, overlap and client drilldown (G-9 ... G-12, G-17, G-18).

Top-k is ``orderBy(score desc, customer_id asc).limit(k)`` with a small fixed
k (a top-k report), which Spark runs as TakeOrderedAndProject: each task keeps
k rows, never a whole partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.config import SignalParams

SIGNAL_COLS = ["customer_id", "buy_propensity", "redemption_risk", "engagement_score",
               "master_signal", "expected_client_value", "opportunity_frontier_score",
               "recommended_action"]
BEHAVIOUR_COLS = ["tx_count", "tx_total", "tx_recency", "tx_max_gap", "tx_late_ratio",
                  "tx_wknd_ratio"]


def top_n(signals: DataFrame, by: str, n: int = 100, cols: list[str] | None = None) -> DataFrame:
    """G-9 / G-10: top n by ``by`` with a stable key tie-break (X-17)."""
    cols = cols or [c for c in SIGNAL_COLS if c in signals.columns]
    ranked = signals.orderBy(F.col(by).desc(), F.col("customer_id").asc()).limit(n)
    return ranked.select(*cols)


def top_opportunities(signals: DataFrame, n: int = 100) -> DataFrame:
    """G-9: by expected client value, falling back to the master signal."""
    by = "expected_client_value" if "expected_client_value" in signals.columns else "master_signal"
    return top_n(signals, by, n)


def ranking_overlap(signals: DataFrame, n: int = 100) -> DataFrame:
    """G-11: sizes of intersect / differences of the two top-n key sets."""
    f = top_n(signals, "opportunity_frontier_score", n, ["customer_id"])
    m = top_n(signals, "master_signal", n, ["customer_id"])
    both = f.intersect(m).agg(F.count(F.lit(1)).alias("both"))
    fo = f.subtract(m).agg(F.count(F.lit(1)).alias("frontier_only"))
    mo = m.subtract(f).agg(F.count(F.lit(1)).alias("master_only"))
    return both.crossJoin(fo).crossJoin(mo)


def hidden_gems(signals: DataFrame, n: int = 100) -> DataFrame:
    """G-12: frontier top-n customers that are not in the master top-n."""
    f = top_n(signals, "opportunity_frontier_score", n)
    m = top_n(signals, "master_signal", n, ["customer_id"])
    return f.join(F.broadcast(m), "customer_id", "left_anti")


def _display(c: str):
    """Number shown by size: ``1,234`` above 100, else three decimals. The noise
    of a sum (beyond six decimals) does not decide how a half is rounded."""
    v = F.round(F.col(c).cast("double"), 6)
    return F.when(v > 100, F.format_number(F.round(v, 0), 0)).otherwise(
        F.format_string("%.3f", F.round(v, 3)))


def drilldown_table(signals: DataFrame, mart: DataFrame) -> DataFrame:
    """G-17 / J-4: signals left-joined with behaviour columns, each shown as
    ``Title Case label`` and a size-dependent number format (NULLs skipped)."""
    beh = [c for c in BEHAVIOUR_COLS if c in mart.columns]
    j = signals.join(mart.select("customer_id", *beh), "customer_id", "left")
    shown = [F.when(F.col(c).isNotNull(), F.struct(
        F.lit(c.replace("_", " ").title()).alias("feature"), _display(c).alias("value")))
        for c in beh]
    return j.select(F.col("customer_id").cast("string").alias("client_id"), *SIGNAL_COLS[1:],
                    F.filter(F.array(*shown), lambda x: x.isNotNull()).alias("behaviour"))


def client_drilldown(signals: DataFrame, mart: DataFrame, client_id: str) -> DataFrame:
    """G-17: one client looked up by its key as a string. The string is turned
    into the key's own type, so that both inputs are filtered by a literal that
    reaches their scans; one that is no such key finds nothing."""
    kind = signals.schema["customer_id"].dataType
    key = signals.sparkSession.range(1).select(F.lit(str(client_id)).try_cast(kind).alias("k")).first()["k"]
    own = F.col("customer_id") == F.lit(key).cast(kind)
    return drilldown_table(signals.where(own), mart.where(own)).where(F.col("client_id") == F.lit(str(client_id)))


def interpretation(signals: DataFrame, p: SignalParams = SignalParams()) -> DataFrame:
    """G-18: four tiers with sub-grades and the formatted explanation."""
    bp, rr, eng = F.col("buy_propensity"), F.col("redemption_risk"), F.col("engagement_score")
    f2 = lambda c: F.format_string("%.2f", F.round(c, 2))
    tier = (F.when((bp > p.upsell_bp) & (rr < p.upsell_rr), "upsell")
            .when(rr > p.retention_rr, "retention")
            .when((bp > p.emerging_bp) & (rr < p.emerging_rr), "emerging")
            .otherwise("monitor"))
    grade = lambda c, cut, high, low: F.when(c > cut, high).otherwise(low)
    scores = F.concat(F.lit(" [growth "), f2(bp), F.lit(", risk "), f2(rr), F.lit(", engagement "), f2(eng), F.lit("]"))
    upsell = F.concat(F.lit("Likely to grow and unlikely to leave; "), grade(eng, 0.5, "highly", "fairly"),
                      F.lit(" active. Offer more."), scores)
    retention = F.concat(F.lit("Likely to leave; "), grade(bp, 0.4, "some", "little"), F.lit(" growth left, "),
                         F.when(eng < 0.3, "activity fading").otherwise("still active"), F.lit(". Get in touch soon."), scores)
    emerging = F.concat(F.lit("May grow, at a risk worth taking. Keep in contact."), scores)
    monitor = F.concat(F.lit("No clear direction. Look again after the next run."), scores)
    text = (F.when(tier == "upsell", upsell).when(tier == "retention", retention)
            .when(tier == "emerging", emerging).otherwise(monitor))
    return signals.select("customer_id", tier.alias("tier"), text.alias("interpretation"))
