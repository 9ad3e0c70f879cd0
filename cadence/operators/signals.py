"""Signal layer (G-1 ... G-8, G-13 ... G-16).

Global statistics (min, max, median, quantile) are a few numbers: the signal
chain reads the extrema of each of its four dependent levels by one aggregate
and puts them in as literals, so the result is one projection of its input;
medians and quantiles come from the exact order statistics. Callers should hand
in a materialised (checkpointed or written) input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.config import SignalParams
from cadence.functions.columns import clip01
from cadence.functions.ordered import order_statistics, quantile_values

_CONST = 10 * 2.220446049250313e-16

ENGAGEMENT_INPUTS = ["tx_freq", "tx_recency", "tx_max_gap", "tx_count_trend", "tx_late_ratio"]


def _scaled(c: Column, mn: Column, mx: Column) -> Column:
    return F.when((mx - mn) < _CONST, F.lit(0.0)).otherwise((c.cast("double") - mn) / (mx - mn))


def minmax_scale(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """G-1: (x - min) / (max - min) over all rows; a constant column maps to 0
    (X-12). Adds ``c + suffix`` (replaces ``c`` when suffix is empty)."""
    stats = df.agg(*[F.min(c).alias(f"_mn_{i}") for i, c in enumerate(cols)],
                   *[F.max(c).alias(f"_mx_{i}") for i, c in enumerate(cols)])
    out = df.crossJoin(F.broadcast(stats))
    own = {c + suffix: _scaled(F.col(c), F.col(f"_mn_{i}"), F.col(f"_mx_{i}")) for i, c in enumerate(cols)}
    return out.withColumns(own).drop(*[f"_{m}_{i}" for m in ("mn", "mx") for i in range(len(cols))])


def scaled_columns(df: DataFrame, exprs: dict[str, Column]) -> dict[str, Column]:
    """G-1 without a join: one aggregate reads the extrema of all ``exprs``
    over ``df``; each comes back scaled, with its extrema as literals."""
    r = df.agg(*[f(e).alias(f"{m}_{i}") for i, e in enumerate(exprs.values()) for m, f in (("mn", F.min), ("mx", F.max))]).first()
    none = F.lit(None).cast("double")
    return {c: none if r[f"mn_{i}"] is None else _scaled(e, F.lit(float(r[f"mn_{i}"])), F.lit(float(r[f"mx_{i}"])))
            for i, (c, e) in enumerate(exprs.items())}


def _engagement_raw(norm: dict[str, Column], p: SignalParams) -> Column:
    return clip01(F.lit(p.w_freq) * norm["tx_freq"] + F.lit(p.w_trend) * norm["tx_count_trend"]
                  + F.lit(p.w_recency) * (1 - norm["tx_recency"]) + F.lit(p.w_gap) * (1 - norm["tx_max_gap"]))


def engagement(df: DataFrame, p: SignalParams = SignalParams()) -> DataFrame:
    """G-2: weighted engagement of min-max-normalised behaviour, clipped to
    [0, 1] (``engagement_raw``). The late ratio is normalised but unused (D-8)."""
    n = minmax_scale(df.fillna(0.0, subset=ENGAGEMENT_INPUTS).fillna(0, subset=ENGAGEMENT_INPUTS),
                     ENGAGEMENT_INPUTS, "_norm")
    e = _engagement_raw({c: F.col(c + "_norm") for c in ENGAGEMENT_INPUTS}, p)
    return n.withColumn("engagement_raw", e).drop(*[c + "_norm" for c in ENGAGEMENT_INPUTS])


def action(bp: Column, rr: Column, p: SignalParams = SignalParams()) -> Column:
    """G-8: first matching rule on the normalised scores (X-16)."""
    return (F.when((bp > p.upsell_bp) & (rr < p.upsell_rr), F.lit("Upsell"))
            .when(rr > p.retention_rr, F.lit("Retention"))
            .otherwise(F.lit("Monitor")))


def signal_table(df: DataFrame, p: SignalParams = SignalParams(), bp: str = "bp_raw",
                 rr: str = "rr_raw") -> DataFrame:
    """G-1 ... G-8: from ``customer_id``, raw calibrated ``bp``/``rr`` and the
    behaviour columns, build the signal frame (one row per customer)."""
    raw = scaled_columns(df, {c: F.coalesce(F.col(c), F.lit(0)) for c in ENGAGEMENT_INPUTS if c != "tx_late_ratio"}
                         | {"bp": F.col(bp), "rr": F.col(rr)})
    # each level needs the extrema of the one before: four narrow aggregates, no joins
    eng = scaled_columns(df, {"e": _engagement_raw(raw, p)})["e"]
    scores = df.select("customer_id", "tx_total", raw["bp"].alias("buy_propensity"), raw["rr"].alias("redemption_risk"),
                       eng.alias("engagement_score"))
    bpn, rrn, e = F.col("buy_propensity"), F.col("redemption_risk"), F.col("engagement_score")
    co = scaled_columns(scores, {"co_additive": bpn * e - rrn, "master_signal": bpn * (1 - rrn) * e})
    v = scores.withColumns(co)
    v = v.withColumn("expected_client_value", F.col("master_signal") * F.coalesce(F.col("tx_total"), F.lit(0.0)))
    frontier = scaled_columns(v, {"f": F.col("expected_client_value") / F.greatest(rrn, F.lit(p.risk_floor))})["f"]
    return v.select("customer_id", "buy_propensity", "redemption_risk", "engagement_score",
                    "master_signal", "co_additive", "expected_client_value",
                    frontier.alias("opportunity_frontier_score"),
                    action(bpn, rrn, p).alias("recommended_action"))


def formulation_correlation(signals: DataFrame) -> DataFrame:
    """G-5: Pearson correlation of the additive and multiplicative forms."""
    return signals.agg(F.corr("co_additive", "master_signal").alias("corr_additive_master"))


def product_score(signals: DataFrame) -> DataFrame:
    """G-13: deterministic product base score .4 eng + .4 bp + .2 (1 - rr)."""
    return signals.withColumn(
        "product_base_score",
        F.col("engagement_score") * 0.4 + F.col("buy_propensity") * 0.4
        + (1 - F.col("redemption_risk")) * 0.2)


def product_quadrant(signals: DataFrame) -> DataFrame:
    """G-14: master signal vs its (exact) median, product score vs 0.5."""
    s = product_score(signals)
    med = F.lit(quantile_values(s, {"median": ("master_signal", 0.5)})["median"]).cast("double")
    hi_m = F.col("master_signal") >= med
    hi_p = F.col("product_base_score") >= 0.5
    quad = (F.when(hi_m & hi_p, "upper_right").when(~hi_m & hi_p, "upper_left")
            .when(hi_m & ~hi_p, "lower_right").otherwise("lower_left"))
    return s.select("customer_id", "master_signal", "product_base_score", med.alias("master_median"), quad.alias("quadrant"))


def strategic_segments(signals: DataFrame, risk_mid: float = 0.5) -> DataFrame:
    """G-15: redemption risk vs 0.5 and ECV (clipped at its 99th percentile)
    vs its median; label anchors at the 92nd and 8th percentile."""
    ecv = F.col("expected_client_value")
    got = order_statistics(signals, ["expected_client_value"], [0.08, 0.5, 0.92, 0.99])
    p99 = got["expected_client_value", 0.99].value()
    # clipping keeps the order, so the clipped quantiles come from the same order statistics
    bot, mid, top = (F.lit(got["expected_client_value", q].value(p99)).cast("double") for q in (0.08, 0.5, 0.92))
    clipped = F.when(ecv.isNotNull(), F.least(ecv, F.lit(p99).cast("double")))
    hv = F.coalesce(clipped >= mid, F.lit(False))   # without a value: not high
    lr = F.col("redemption_risk") < risk_mid
    seg = (F.when(hv & lr, "STRATEGIC UPSELL").when(hv & ~lr, "RETENTION PRIORITY")
           .when(~hv & lr, "STABLE / LOW PRIORITY").otherwise("MONITOR"))
    return signals.select("customer_id", "redemption_risk", clipped.alias("ecv_clipped"), mid.alias("ecv_median"),
                          top.alias("label_top"), bot.alias("label_bottom"), seg.alias("segment"))


def frontier_zone(signals: DataFrame, p: SignalParams = SignalParams()) -> DataFrame:
    """G-16: zones of the propensity-risk plane (lines at bp .6 and rr .3)."""
    hi = F.col("buy_propensity") > p.upsell_bp
    zone = (F.when(hi & (F.col("redemption_risk") < p.upsell_rr), "HIGH OPP LOW RISK")
            .when(hi, "HIGH OPP HIGH RISK").otherwise("LOW OPPORTUNITY"))
    return signals.select("customer_id", "buy_propensity", "redemption_risk", zone.alias("zone"))
