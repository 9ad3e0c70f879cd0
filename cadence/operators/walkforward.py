"""Expanding-window walk-forward validation (V-1 ... V-7).

All folds are built in ONE job: the log is pre-aggregated to
(customer, period, type) with count, amount count, sum, squared deviations and
last date - period = month when every fold edge is a month start (the
reference's folds are), else day - and that much smaller table is range-joined
to the broadcast fold table (J-7). A customer with a third of all rows still
contributes at most one row per period and type.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.config import STABILITY_STD, Fold
from cadence.functions.columns import lit_date
from cadence.functions.ordered import MEDIAN_SKETCH
from cadence.operators.features import (
    INT_COLS, daily_activity, exact_medians, placed_days, share_names, tx_feature_columns, window_features,
)


def fold_table(spark: SparkSession, folds: tuple[Fold, ...], obs_start: dt.date) -> DataFrame:
    """V-1: the fold configuration as a small DataFrame (broadcast by users)."""
    rows = [(f.fold, obs_start, f.obs_end, f.pred_start, f.pred_end, float(f.obs_periods),
             float(f.pred_periods)) for f in folds]
    return spark.createDataFrame(
        rows, "fold int, obs_start date, obs_end date, pred_start date, pred_end date, "
              "obs_periods double, pred_periods double")


def period_grain(folds: tuple[Fold, ...], obs_start: dt.date) -> str:
    edges = [obs_start] + [d for f in folds for d in (f.obs_end, f.pred_start, f.pred_end)]
    return "MM" if all(d.day == 1 for d in edges) else "DD"


def period_aggregate(tx: DataFrame, grain: str) -> DataFrame:
    """(customer, period, type) pre-aggregate of the log."""
    p = F.trunc("date", "MM") if grain == "MM" else F.col("date")
    return tx.groupBy("customer_id", p.alias("period"), "type").agg(
        F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_amt"),
        F.sum("amount").alias("s"), (F.var_pop("amount") * F.count("amount")).alias("m2"),
        F.max("date").alias("last"))


def fold_frame(spark: SparkSession, tx: DataFrame, spine: DataFrame, folds: tuple[Fold, ...],
               obs_start: dt.date, types, disengage_ratio: float = 0.20) -> DataFrame:
    """V-2 / V-3: one row per (fold, customer) with the fold's features
    (count, total, mean, std, cv, recency, type shares; NULL -> 0) and its
    disengagement label over the fold's period counts."""
    ft = fold_table(spark, folds, obs_start)
    pre = period_aggregate(tx.where(F.col("date") >= lit_date(obs_start)),
                           period_grain(folds, obs_start))
    # sums around the customer's own mean, so that the variance does not cancel
    own = Window.partitionBy("customer_id")
    centre = F.sum("s").over(own) / F.nullif(F.sum("n_amt").over(own), F.lit(0))
    pre = pre.withColumn("_c", F.when(F.col("n_amt") > 0, centre))
    off = F.col("s") - F.col("n_amt") * F.col("_c")
    pre = pre.withColumn("d", off).withColumn("ss", F.col("m2") + off * off / F.nullif(F.col("n_amt"), F.lit(0)))
    j = pre.join(F.broadcast(ft), (F.col("period") >= F.col("obs_start")) & (
        F.col("period") < F.col("pred_end")))
    o = (F.col("period") < F.col("obs_end"))
    fu = (F.col("period") >= F.col("pred_start")) & (F.col("period") < F.col("pred_end"))
    names = share_names(types)
    aggs = [
        F.sum(F.when(o, F.col("n"))).alias("oc"), F.sum(F.when(fu, F.col("n"))).alias("fc"),
        F.sum(F.when(o, F.col("n_amt"))).alias("tx_count"), F.sum(F.when(o, F.col("s"))).alias("tx_total"),
        F.sum(F.when(o, F.col("ss"))).alias("_ss"), F.sum(F.when(o, F.col("d"))).alias("_d"), F.max(F.when(o, F.col("last"))).alias("_last"),
        F.sum(F.when(o & F.col("type").isNotNull(), F.col("n"))).alias("_typed"),
    ] + [F.sum(F.when(o & (F.col("type") == t), F.col("n"))).alias("_n_" + name) for t, name in names.items()]
    a = j.groupBy("fold", "customer_id").agg(*aggs)
    n, s = F.col("tx_count").cast("double"), F.col("tx_total")
    mean = F.when(n > 0, s / n)
    var = F.when(n >= 2, F.greatest((F.col("_ss") - F.col("_d") * F.col("_d") / n) / (n - 1), F.lit(0.0)))
    a = (a.withColumn("tx_mean", mean)
          .withColumn("tx_std", F.coalesce(F.sqrt(var), F.lit(0.0))))
    a = a.withColumn("tx_cv", F.col("tx_std") / F.greatest(F.col("tx_mean"), F.lit(1.0)))
    for name in names.values():
        a = a.withColumn(name, F.when(F.col("_typed") > 0, F.col("_n_" + name) / F.col("_typed")))
    sp = spine.select("customer_id").crossJoin(F.broadcast(ft))
    out = sp.join(a, ["fold", "customer_id"], "left")
    out = out.withColumn("tx_recency", F.datediff(F.date_sub(F.col("obs_end"), 1), F.col("_last")))
    feat = ["tx_count", "tx_total", "tx_mean", "tx_std", "tx_cv", "tx_recency",
            *names.values()]
    out = out.fillna(0, subset=["oc", "fc"] + feat).fillna(0.0, subset=feat)
    om = F.col("oc") / F.col("obs_periods")
    fm = F.col("fc") / F.col("pred_periods")
    ratio = F.when(om > 0, fm / om).when(F.col("fc") > 0, 1.0).otherwise(0.0)
    label = ((F.col("fc") == 0) | (ratio < disengage_ratio)).cast("int")
    return out.select("fold", "customer_id", F.col("oc").cast("long").alias("obs_count"),
                      F.col("fc").cast("long").alias("fut_count"),
                      F.col("tx_count").cast("long").alias("tx_count"),
                      *[F.col(c).cast("int" if c == "tx_recency" else "double").alias(c)
                        for c in feat[1:]],
                      label.alias("future_disengaged"))


def full_fold_frame(spark: SparkSession, tx: DataFrame, spine: DataFrame, folds: tuple[Fold, ...],
                    obs_start: dt.date, types, disengage_ratio: float = 0.20,
                    heaviest: int | None = None) -> DataFrame:
    """V-2 / V-3 with all transaction features (D-7): one row per (fold,
    customer) with the features of the mart - median, trends, gap and late ratio
    included - over the fold's window, and its disengagement label.

    One (customer, day) table serves all folds: their windows start together,
    so a day's predecessor and the ordinal of its month are the same in each,
    and only the last aggregate is by fold. The late part of a window is the
    last third of its days. ``heaviest`` as in ``customer_mart``."""
    late = [(f.fold, f.obs_end - dt.timedelta(days=(f.obs_end - obs_start).days // 3), 2.0 * f.obs_periods / 3,
             f.obs_periods / 3) for f in folds]
    ft = fold_table(spark, folds, obs_start).join(F.broadcast(spark.createDataFrame(
        late, "fold int, late_start date, early_periods double, late_periods double")), "fold")
    tx = tx.where(F.col("date") >= lit_date(obs_start))
    days = placed_days(daily_activity(tx, types))
    j = days.join(F.broadcast(ft), F.col("date") < F.col("pred_end"))
    o = F.col("date") < F.col("obs_end")
    ahead = (F.col("date") >= F.col("pred_start")) & (F.col("date") < F.col("pred_end"))
    keys = ["fold", "customer_id"]
    a = window_features(j, keys, o, F.col("prev").isNotNull(), F.date_sub("obs_end", 1), F.col("late_start"),
                        F.col("early_periods"), F.col("late_periods"), types, {"obs_count": o, "fut_count": ahead})
    if heaviest is None or heaviest > MEDIAN_SKETCH:
        amounts = tx.join(F.broadcast(ft), F.col("date") < F.col("obs_end")).select(*keys, "amount")
        a = exact_medians(a, keys, amounts)
    feat = tx_feature_columns(types)
    sp = spine.select("customer_id").crossJoin(F.broadcast(ft.select("fold", "obs_periods", "pred_periods")))
    out = sp.join(a.select(*keys, "obs_count", "fut_count", *feat), keys, "left")
    out = out.select(*keys, "obs_periods", "pred_periods",
                     *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("obs_count", "fut_count")],
                     *[F.coalesce(F.col(c), F.lit(0)).cast(INT_COLS.get(c, "double")).alias(c) for c in feat])
    om, fm = F.col("obs_count") / F.col("obs_periods"), F.col("fut_count") / F.col("pred_periods")
    ratio = F.when(om > 0, fm / om).when(F.col("fut_count") > 0, 1.0).otherwise(0.0)
    label = ((F.col("fut_count") == 0) | (ratio < disengage_ratio)).cast("int")
    return out.select(*keys, "obs_count", "fut_count", *feat, label.alias("future_disengaged"))


def fold_labels_summary(ff: DataFrame, ft: DataFrame) -> DataFrame:
    """V-5: per fold the window labels (``%b``) and the target rate."""
    lab = ff.groupBy("fold").agg(F.avg(F.col("future_disengaged").cast("double")).alias("target_rate"))
    wl = ft.select(
        "fold",
        F.concat(F.date_format("obs_start", "MMM"), F.lit("-"),
                 F.date_format(F.date_sub("obs_end", 1), "MMM")).alias("obs_window"),
        F.concat(F.date_format("pred_start", "MMM"), F.lit("-"),
                 F.date_format(F.date_sub("pred_end", 1), "MMM")).alias("pred_window"))
    return wl.join(lab, "fold")


def fold_stability(results: DataFrame, metric: str = "roc_auc",
                   threshold: float = STABILITY_STD) -> DataFrame:
    """V-6 / V-7: mean, sample std (verdict: stable below ``threshold``),
    population std and the mean +- population-std band."""
    m, s, sp = F.avg(metric), F.stddev_samp(metric), F.stddev_pop(metric)
    return results.agg(m.alias("mean"), s.alias("std"), sp.alias("std_pop"),
                       (m - sp).alias("band_low"), (m + sp).alias("band_high"),
                       F.when(s < threshold, "stable").otherwise("unstable").alias("verdict"))
