"""Observation-window behaviour features (F-1 ... F-19).

Plan shape (per customer key ``k``): one scan of the log is reduced to a
``(k, day)`` table of mergeable parts: row counts, amount moments, extrema,
counts per type and a bounded sketch of the amounts (partly aggregated before
the shuffle, so a customer with a third of all rows ships one row per day and
input partition). Everything else comes from that table: labels, RFM block,
type shares, calendar features and the exact median. It is shuffled by ``k``
once and sorted by day; the windows over it and the customer aggregate keep
that order.

The median is exact. A sketch holds all amounts of a customer up to
``MEDIAN_SKETCH`` of them; customers with more get a bracket from their sketch
and their median by counting (``functions.ordered.bracket_medians``), which
reads the log again for those customers only.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cadence.config import LabelRules, WindowSpec
from cadence.functions.columns import is_weekend, lit_date, safe_ratio
from cadence.functions.ordered import MEDIAN_SKETCH, bracket_medians, sketch_bounds
from cadence.operators.targets import in_obs, in_pred, label_columns

RFM_COLS = ["tx_count", "tx_total", "tx_mean", "tx_median", "tx_std", "tx_min", "tx_max",
            "tx_cv", "tx_recency", "tx_span", "tx_freq"]
TAIL_COLS = ["tx_wknd_ratio", "tx_count_trend", "tx_amt_trend", "tx_max_gap", "tx_late_ratio"]
INT_COLS = {"tx_count": "long", "tx_recency": "int", "tx_span": "int", "tx_max_gap": "int"}


def share_names(types: Sequence[str]) -> dict[str, str]:
    """F-10 naming: type -> ``sh_<lower(type)>`` (non-identifier characters
    become _). Types that would share a name are numbered in their order."""
    names: dict[str, str] = {}
    taken: set[str] = set()
    for t in types:
        base = name = "sh_" + re.sub(r"[^0-9a-z_]", "_", t.lower())
        n = 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names[t] = name
    return names


def tx_feature_columns(types: Sequence[str]) -> list[str]:
    """The transaction feature list in reference order (20 for four types)."""
    return RFM_COLS + list(share_names(types).values()) + TAIL_COLS


def daily_activity(tx: DataFrame, types: Sequence[str]) -> DataFrame:
    """(customer, day) table of mergeable parts. Columns that no feature asks
    for are pruned from the aggregate (the sketch, if no median is wanted)."""
    n_amt = F.count("amount")
    return tx.groupBy("customer_id", "date").agg(
        F.count(F.lit(1)).alias("n"), n_amt.alias("n_amt"), F.sum("amount").alias("s"),
        (F.var_pop("amount") * n_amt).alias("m2"), F.min("amount").alias("mn"), F.max("amount").alias("mx"),
        F.count("type").alias("n_typed"),
        *[F.count_if(F.col("type") == F.lit(t)).alias(f"t{i}") for i, t in enumerate(types)],
        F.when(n_amt > 0, F.kll_sketch_agg_double("amount", F.lit(MEDIAN_SKETCH))).alias("sketch"))


def placed_days(days: DataFrame) -> DataFrame:
    """Adds, per customer, the previous active day, the ordinal ``x`` of the
    month among the active months, and a centre for the variance (one sort)."""
    own = Window.partitionBy("customer_id")
    upto = own.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = days.withColumn("prev", F.lag("date").over(own.orderBy("date")))
    same_month = F.coalesce(F.trunc("prev", "MM") == F.trunc("date", "MM"), F.lit(False))
    return d.withColumns({"x": F.sum((~same_month).cast("long")).over(upto),
                          "centre": F.sum("s").over(own) / F.nullif(F.sum("n_amt").over(own), F.lit(0))})


def window_features(days: DataFrame, keys: list[str], o: Column, prev_in: Column, last_day: Column,
                    late_start: Column, early_periods: Column, late_periods: Column, types: Sequence[str],
                    counts: dict[str, Column] | None = None) -> DataFrame:
    """F-1 ... F-16 over the days ``o`` of each ``keys`` group of placed days.

    * variance: day sums around the customer's centre, so large amounts do not
      cancel;
    * trends: OLS slope over the ordinal of active months (empty months
      skipped, X-3) in closed form; fewer than two months -> 0 (X-4); the amount
      slope is divided by the mean monthly amount, 0 when that mean is 0;
    * gap: one event -> days to the window end; several events -> largest
      difference between consecutive active days (0 when all on one day, X-5).

    ``counts`` names further row counts by their condition. ``tx_median`` is NULL for groups of more than ``MEDIAN_SKETCH`` amounts;
    ``_lo``, ``_hi`` bracket it."""
    def inside(c: str | Column) -> Column:
        return F.when(o, F.col(c) if isinstance(c, str) else c)

    x, amt = F.col("x"), F.coalesce("s", F.lit(0.0))
    off = F.col("s") - F.col("n_amt") * F.col("centre")
    counts = counts or {}
    a = days.groupBy(*keys).agg(
        *[F.sum(F.when(c, F.col("n"))).alias(name) for name, c in counts.items()],
        F.sum(inside("n")).alias("_n"), F.sum(inside("n_amt")).alias("_na"), F.sum(inside("s")).alias("tx_total"),
        F.sum(inside(F.col("m2") + off * off / F.nullif(F.col("n_amt"), F.lit(0)))).alias("_ss"),
        F.sum(inside(off)).alias("_off"), F.min(inside("mn")).alias("tx_min"), F.max(inside("mx")).alias("tx_max"),
        F.min(inside("date")).alias("_first"), F.max(inside("date")).alias("_last"),
        F.sum(inside("n_typed")).alias("_typed"), *[F.sum(inside(f"t{i}")).alias(f"_t{i}") for i in range(len(types))],
        F.sum(inside(F.when(is_weekend(F.col("date")), F.col("n")).otherwise(0))).alias("_wknd"),
        F.sum(F.when(o & (F.col("date") < late_start), F.col("n"))).alias("_early"),
        F.sum(F.when(o & (F.col("date") >= late_start), F.col("n"))).alias("_late"),
        F.count_if(o).alias("_days"), F.max(F.when(o & prev_in, F.datediff("date", "prev"))).alias("_gap"),
        F.min(inside("x")).alias("_x0"), F.max(inside("x")).alias("_x1"),
        F.sum(inside(x * F.col("n"))).alias("_xn"), F.sum(inside(x * amt)).alias("_xa"), F.sum(inside(amt)).alias("_sa"),
        F.kll_merge_agg_double(inside("sketch"), F.lit(MEDIAN_SKETCH)).alias("_sketch"),
        F.max(last_day).alias("_end"), F.max(early_periods).alias("_ep"), F.max(late_periods).alias("_lp"))
    na = F.coalesce("_na", F.lit(0))
    n = na.cast("double")
    std = F.sqrt(F.when(na >= 2, F.greatest((F.col("_ss") - F.col("_off") * F.col("_off") / n) / (n - 1), F.lit(0.0))))
    months = (F.col("_x1") - F.col("_x0") + 1).cast("double")

    def slope(xy: str, y: str) -> Column:
        own = F.col(xy) - F.col("_x0") * F.col(y) - (months - 1) / 2 * F.col(y)
        return F.when(months >= 2, own / (months * (months * months - 1) / 12))

    early, late = F.coalesce("_early", F.lit(0)), F.coalesce("_late", F.lit(0))
    low, high, lo, hi = sketch_bounds("_sketch", "_na")
    total, end, last = F.col("tx_total"), F.col("_end"), F.col("_last")
    mean = F.when(na > 0, total / n)
    std = F.coalesce(std, F.lit(0.0))
    span = F.when(last.isNotNull(), F.greatest(F.datediff(last, F.col("_first")), F.lit(1)))
    amt_slope = slope("_xa", "_sa") / (F.col("_sa") / months)
    return a.select(
        *keys, *counts, "tx_total", "tx_min", "tx_max", "_na", na.alias("tx_count"), mean.alias("tx_mean"), std.alias("tx_std"),
        ((low + high) / 2).alias("tx_median"), lo.alias("_lo"), hi.alias("_hi"),
        (std / F.greatest(mean, F.lit(1.0))).alias("tx_cv"),
        F.datediff(end, last).alias("tx_recency"), span.alias("tx_span"), (n / span).alias("tx_freq"),
        *[safe_ratio(F.col(f"_t{i}"), F.col("_typed")).alias(name) for i, name in enumerate(share_names(types).values())],
        (F.col("_wknd") / F.nullif(F.col("_n").cast("double"), F.lit(0.0))).alias("tx_wknd_ratio"),
        F.coalesce(slope("_xn", "_n"), F.lit(0.0)).alias("tx_count_trend"),
        F.when(F.col("_sa") != 0, F.coalesce(amt_slope, F.lit(0.0))).otherwise(F.lit(0.0)).alias("tx_amt_trend"),
        F.when(F.col("_n") == 1, F.datediff(end, last)).when(F.col("_days") == 1, F.lit(0))
        .otherwise(F.col("_gap")).cast("int").alias("tx_max_gap"),
        F.when(early > 0, (late / F.col("_lp")) / (early / F.col("_ep"))).when(late > 0, F.lit(2.0))
        .otherwise(F.lit(0.0)).alias("tx_late_ratio"))


def exact_medians(features: DataFrame, keys: list[str], amounts: DataFrame) -> DataFrame:
    """``features`` with the medians that their sketches do not hold, from a
    count of ``amounts`` (keys, ``amount``) inside the groups' brackets."""
    large = features.where(F.col("_na") > MEDIAN_SKETCH).select(
        *keys, F.col("_na").alias("n"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
        F.col("tx_min").alias("mn"), F.col("tx_max").alias("mx"))
    counted = bracket_medians(amounts, large, keys, "amount").withColumnRenamed("median", "_counted")
    return features.join(counted, keys, "left").withColumn("tx_median", F.coalesce("tx_median", "_counted"))


def infer_feature_groups(df: DataFrame, ordinal: dict, nominal: list[str],
                         key: str = "customer_id") -> dict[str, list[str]]:
    """F-17: numeric features are the columns of any numeric type; ordinal and
    nominal are named."""
    numeric = [f.name for f in df.schema.fields
               if f.name != key and isinstance(f.dataType, NumericType)
               and f.name not in ordinal and f.name not in nominal]
    return {"numeric": numeric, "ordinal": [c for c in ordinal if c in df.columns],
            "nominal": [c for c in nominal if c in df.columns]}


def customer_mart(spine: DataFrame, tx: DataFrame, w: WindowSpec, types: Sequence[str],
                  rules: LabelRules = LabelRules(), with_labels: bool = True,
                  columns: list[str] | None = None, heaviest: int | None = None) -> DataFrame:
    """F-18 (+ T3-T8): one row per spine customer with the 20 transaction
    features (structural zero for customers without observation rows) and,
    when ``with_labels``, the window counts and both labels. ``columns``
    restricts the output and the work. ``heaviest`` is a known bound on the
    amounts of one customer: up to ``MEDIAN_SKETCH`` no second read is needed
    for the medians; without it the customers are looked at first."""
    types = tuple(types)
    feat = tx_feature_columns(types)
    if columns is not None:
        feat = [c for c in feat if c in columns]
    days = placed_days(daily_activity(tx, types))
    o = in_obs(w)
    parts = window_features(days, ["customer_id"], o, in_obs(w, F.col("prev")), lit_date(w.obs_last_day),
                            lit_date(w.late_start), F.lit(float(w.early_periods)), F.lit(float(w.late_periods)),
                            types, {"obs_count": o, "fut_count": in_pred(w)})
    if "tx_median" in feat and (heaviest is None or heaviest > MEDIAN_SKETCH):
        parts = exact_medians(parts, ["customer_id"], tx.where(o).select("customer_id", "amount"))
    count_cols = ["obs_count", "fut_count"] if with_labels else []
    out = spine.select("customer_id").join(parts.select("customer_id", *count_cols, *feat), "customer_id", "left")
    out = out.select("customer_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in count_cols],
                     *[F.coalesce(F.col(c), F.lit(0)).cast(INT_COLS.get(c, "double")).alias(c) for c in feat])
    if with_labels:
        out = label_columns(out, w, rules)
        out = out.select("customer_id", "obs_count", "fut_count", "obs_monthly", "fut_monthly",
                         "activity_ratio", "future_disengaged", "future_growth", *feat)
    return out


def transaction_features(spine: DataFrame, tx: DataFrame, w: WindowSpec, types: Sequence[str]) -> DataFrame:
    """The 20 transaction features alone (no labels)."""
    return customer_mart(spine, tx, w, types, with_labels=False)
