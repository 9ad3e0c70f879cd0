"""Temporal split and the two prediction-window labels (T1-T10).

Windows are half-open on dates (trap X-1): ``obs = [obs_start, obs_end)``,
``pred = [pred_start, pred_end)``. Both window counts come from ONE grouped
aggregate of the log (conditional counts), then a left join onto the customer
spine fills customers without rows with 0 (T4).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.config import LabelRules, WindowSpec
from cadence.functions.columns import lit_date


def in_obs(w: WindowSpec, date: Column | None = None) -> Column:
    """T1: observation predicate."""
    d = F.col("date") if date is None else date
    inside = d < lit_date(w.obs_end)
    return inside if w.obs_start is None else (d >= lit_date(w.obs_start)) & inside


def in_pred(w: WindowSpec, date: Column | None = None) -> Column:
    """T2: prediction predicate, open at the top without ``pred_end``."""
    d = F.col("date") if date is None else date
    inside = d >= lit_date(w.pred_start)
    return inside if w.pred_end is None else inside & (d < lit_date(w.pred_end))


def window_counts(tx: DataFrame, w: WindowSpec) -> DataFrame:
    """T3: events per customer in each window, one pass, one shuffle."""
    return tx.groupBy("customer_id").agg(
        F.count_if(in_obs(w)).alias("obs_count"),
        F.count_if(in_pred(w)).alias("fut_count"),
    )


def spine_fill(spine: DataFrame, parts: DataFrame, cols: list[str]) -> DataFrame:
    """T4 / J-1: every customer of the spine, missing rows become 0."""
    out = spine.select("customer_id").join(parts, "customer_id", "left")
    return out.fillna(0, subset=cols)


def label_columns(df: DataFrame, w: WindowSpec, rules: LabelRules = LabelRules()) -> DataFrame:
    """T5-T8 on a frame with ``obs_count`` and ``fut_count``."""
    df = df.withColumns({"obs_monthly": F.col("obs_count").cast("double") / F.lit(float(w.obs_periods)),
                         "fut_monthly": F.col("fut_count").cast("double") / F.lit(float(w.pred_periods))})
    ratio = (
        F.when(F.col("obs_monthly") > 0, F.col("fut_monthly") / F.col("obs_monthly"))
        .when(F.col("fut_count") > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    diseng = (F.col("fut_count") == 0) | (ratio < F.lit(rules.disengage_ratio))
    growth = (F.col("fut_monthly") >= F.lit(rules.growth_factor) * F.col("obs_monthly")) | (
        (F.col("obs_monthly") == 0) & (F.col("fut_count") > 0))
    return df.withColumns({"activity_ratio": ratio, "future_disengaged": diseng.cast("int"),
                           "future_growth": growth.cast("int")})


def labels(spine: DataFrame, tx: DataFrame, w: WindowSpec,
           rules: LabelRules = LabelRules()) -> DataFrame:
    """Label table: one row per spine customer (T3-T8)."""
    counts = window_counts(tx, w)
    return label_columns(spine_fill(spine, counts, ["obs_count", "fut_count"]), w, rules)


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """T9: n and percent (1 dp) per label value; the total is a one-row
    aggregate crossed onto the (two-row) result."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select(label, "n", F.round(F.col("n") * 100.0 / F.col("_total"), 1).alias("pct")))


def base_rate(df: DataFrame, label: str) -> DataFrame:
    """T10: total, positives, rate and imbalance ratio n0 / max(n1, 1)."""
    pos = F.sum(F.col(label).cast("long"))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("n_total"),
        pos.alias("n_pos"),
        (pos / total).alias("pos_rate"),
        ((total - pos) / F.greatest(pos, F.lit(1))).cast("double").alias("imbalance_ratio"),
    )
