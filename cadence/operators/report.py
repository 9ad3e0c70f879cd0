"""Chart data and report aggregates (H-3 ... H-7, R-1 ... R-10).

Charts are re-aimed as small aggregate tables: binning is an expression on the
extrema of each series (one broadcast row a series), so no chart needs the rows
on the driver or shuffled by series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cadence.functions.ordered import first_brackets, order_statistics, quantile_row, quantile_values, value_columns
from cadence.operators.features import share_names

SIGNALS_5 = ["buy_propensity", "redemption_risk", "engagement_score", "master_signal",
             "expected_client_value"]


#: Series of a histogram; their extrema are one broadcast row each. More raise an error.
MAX_SERIES = 10_000


def histograms(df: DataFrame, cols: list[str], bins: int = 30, by: str | None = None,
               clip_q: float | None = None) -> DataFrame:
    """H-3 / H-4 / H-7: equal-width bins of several columns over each series'
    own min/max (last bin closed, X-22), NULLs dropped, optionally clipped at
    the column's (exact, linear) quantile first; ``feature, series, bin, bin_lo,
    bin_hi, count, density`` of non-empty bins. A constant series spans
    [x - 0.5, x + 0.5].

    One read finds the extrema of all columns and series (and the brackets of
    the clip points), one counts inside the brackets if there is a clip, one
    counts all bins; rows are counted where they are. The extrema of a clipped
    series follow from the raw ones, since clipping keeps the order."""
    series = F.col(by).cast("string") if by else F.lit("all")
    d = df.select(series.alias("series"), *value_columns(cols))
    rows = (d.rollup("series").agg(F.grouping_id().alias("whole"), *first_brackets(len(cols), [clip_q or 0.5]))
            .limit(MAX_SERIES + 3).collect())
    if sum(not r["whole"] and r["series"] is not None for r in rows) > MAX_SERIES:
        raise ValueError(f"{by} has more than {MAX_SERIES} series")
    total = next((r for r in rows if r["whole"]), None)
    most: dict[str, float | None] = {}
    if clip_q and total is not None:
        most = {c: s.value() for (c, _), s in order_statistics(df, cols, [clip_q], total).items()}
    spans = []
    for r in rows:
        own = []
        for i, c in enumerate(cols):
            lo, hi, cut = r[f"lo{i}"], r[f"hi{i}"], most.get(c)
            if cut is not None and lo is not None:
                lo, hi = min(lo, cut), min(hi, cut)
            if lo is not None and lo == hi:
                lo, hi = lo - 0.5, hi + 0.5
            own.append((lo, hi, r[f"n{i}"]))
        if not r["whole"] and r["series"] is not None:
            spans.append((r["series"], own))
    st = df.sparkSession.createDataFrame(spans, "series string, spans array<struct<lo:double,hi:double,n:long>>")
    j = d.join(F.broadcast(st), "series")

    def placed(i: int, c: str) -> Column:
        x = F.col(f"v{i}") if most.get(c) is None else F.least(F.col(f"v{i}"), F.lit(most[c]))
        span = F.col("spans")[i]
        b = F.least(F.floor((x - span["lo"]) * bins / (span["hi"] - span["lo"])), F.lit(bins - 1)).cast("int")
        return F.when(F.col(f"v{i}").isNotNull(), F.struct(F.lit(i).alias("i"), b.alias("bin")))

    cells = j.select("series", F.explode(F.array(*[placed(i, c) for i, c in enumerate(cols)])).alias("p")).where("p is not null")
    counts = cells.groupBy("series", "p.i", "p.bin").agg(F.count(F.lit(1)).alias("count"))
    h = counts.join(F.broadcast(st), "series").withColumn("s", F.col("spans")[F.col("i")])
    w = (F.col("s.hi") - F.col("s.lo")) / bins
    return h.select(F.array(*[F.lit(c) for c in cols])[F.col("i")].alias("feature"), "series", "bin",
                    (F.col("s.lo") + F.col("bin") * w).alias("bin_lo"), (F.col("s.lo") + (F.col("bin") + 1) * w).alias("bin_hi"),
                    "count", (F.col("count") / (F.col("s.n") * w)).alias("density"))


def histogram(df: DataFrame, col: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """H-3 of one column."""
    return histograms(df, [col], bins, by).drop("feature")


def clip_upper(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    """H-4: clip a column at its (exact, linear) quantile over all rows; NULL
    stays NULL."""
    most = F.lit(quantile_values(df, {"most": (col, q)})["most"]).cast("double")
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.least(F.col(col), most)))


def class_histograms(df: DataFrame, cols: list[str], label: str, bins: int = 30,
                     clip_q: float | None = 0.99) -> DataFrame:
    """H-7: per-class histograms of several columns (optionally clipped at
    the 99th percentile first), long format with a ``feature`` column."""
    return histograms(df, cols, bins, label, clip_q)


def density_grid(df: DataFrame, x: str, y: str, gridsize: int = 40) -> DataFrame:
    """H-5: 2-D density of two scores on a square grid, non-empty cells."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    st = d.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"),
               F.max("y").alias("y1"))
    j = d.crossJoin(F.broadcast(st))

    def cell(v, lo, hi):
        span = F.col(hi) - F.col(lo)
        return F.when(span <= 0, F.lit(0)).otherwise(
            F.least(F.floor((F.col(v) - F.col(lo)) * gridsize / span), F.lit(gridsize - 1))).cast("int")

    return j.groupBy(cell("x", "x0", "x1").alias("cx"), cell("y", "y0", "y1").alias("cy")).agg(
        F.count(F.lit(1)).alias("count"))


def marker_size(df: DataFrame, col: str, smin: float = 2.0, smax: float = 60.0) -> DataFrame:
    """H-6: value / max * 60 clipped to [2, 60]."""
    mx = df.agg(F.max(col).alias("_mx"))
    rel = F.when(F.col("_mx") != 0, F.col(col) / F.col("_mx")).otherwise(F.lit(0.0))
    size = F.when(F.col(col).isNotNull(), F.least(F.greatest(rel * smax, F.lit(smin)), F.lit(smax)))
    return df.crossJoin(F.broadcast(mx)).withColumn("marker_size", size).drop("_mx")


def action_distribution(signals: DataFrame) -> DataFrame:
    """R-2: customers per recommended action."""
    return signals.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("n"))


def signal_means(signals: DataFrame) -> DataFrame:
    """R-3: mean of each signal."""
    return signals.agg(*[F.avg(c).alias(f"mean_{c}") for c in SIGNALS_5[:4]])


def correlation_matrix(signals: DataFrame, cols: list[str] = SIGNALS_5) -> DataFrame:
    """R-4: Pearson correlation of every pair in one aggregate, long format."""
    pairs = [(a, b) for a in cols for b in cols]
    one = signals.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("pearson"))
        for i, (a, b) in enumerate(pairs)])).alias("s")).select("s.*")


def ecv_summary(signals: DataFrame) -> DataFrame:
    """R-5: median, mean, p99, count and max of the expected client value."""
    q = quantile_row(signals, {"median": ("expected_client_value", 0.5),
                               "p99": ("expected_client_value", 0.99)})
    a = signals.agg(F.avg("expected_client_value").alias("mean"),
                    F.count("expected_client_value").alias("n"),
                    F.max("expected_client_value").alias("max"))
    return q.crossJoin(a)


def frontier_summary(signals: DataFrame) -> DataFrame:
    """R-6: mean, median and max of the frontier score."""
    q = quantile_row(signals, {"median": ("opportunity_frontier_score", 0.5)})
    a = signals.agg(F.avg("opportunity_frontier_score").alias("mean"),
                    F.max("opportunity_frontier_score").alias("max"))
    return a.crossJoin(q)


def top_ecv_total(top: DataFrame) -> DataFrame:
    """R-7: total expected value of a top list."""
    return top.agg(F.sum("expected_client_value").alias("top_total_ecv"),
                   F.count(F.lit(1)).alias("n"))


def _best_row(evaluation: DataFrame, target: str) -> DataFrame:
    """The configuration with the largest AUC (to nine digits; ties by name)."""
    return (evaluation.orderBy(F.round("roc_auc", 9).desc_nulls_last(), "setup", "model").limit(1)
            .select(F.col("setup").alias(f"best_{target}_setup"), F.col("model").alias(f"best_{target}_model"),
                    F.col("roc_auc").alias(f"best_{target}_auc")))


def run_summary(labels: DataFrame, signals: DataFrame, risk: DataFrame, growth: DataFrame) -> DataFrame:
    """R-8: one-row summary of a run. ``labels`` has the split; ``risk`` and
    ``growth`` are evaluation tables."""
    lab = labels.agg(F.count(F.lit(1)).alias("n_customers"),
                     *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")],
                     F.avg(F.col("future_disengaged").cast("double")).alias("disengaged_rate"),
                     F.avg(F.col("future_growth").cast("double")).alias("growth_rate"))
    act = signals.agg(*[F.count_if(F.col("recommended_action") == a).alias(f"n_{a.lower()}")
                        for a in ("Upsell", "Retention", "Monitor")],
                      *[F.avg(c).alias(f"mean_{c}")
                        for c in ("master_signal", "engagement_score", "expected_client_value")])
    best = _best_row(risk, "risk").crossJoin(_best_row(growth, "growth"))
    return lab.crossJoin(act).join(best, F.lit(True), "left")


def metric_highlights(table: DataFrame) -> DataFrame:
    """R-9: flag the best value of each metric (max AUC/PR/lift, min Brier)."""
    best = table.agg(F.max("roc_auc").alias("_a"), F.max("pr_auc").alias("_p"),
                     F.max("lift_top_decile").alias("_l"), F.min("brier").alias("_b"))
    return (table.crossJoin(F.broadcast(best))
            .withColumn("best_roc_auc", F.col("roc_auc") == F.col("_a"))
            .withColumn("best_pr_auc", F.col("pr_auc") == F.col("_p"))
            .withColumn("best_lift", F.col("lift_top_decile") == F.col("_l"))
            .withColumn("best_brier", F.col("brier") == F.col("_b"))
            .drop("_a", "_p", "_l", "_b"))


def headline_kpis(evaluation: DataFrame, folds: DataFrame, signals: DataFrame) -> DataFrame:
    """R-1: best Full AUC, best Tx-strict AUC, fold mean +- std, upsell count."""
    e = evaluation.agg(F.max(F.when(F.col("setup") == "Full", F.col("roc_auc"))).alias("best_full_auc"),
                       F.max(F.when(F.col("setup") == "Tx-strict", F.col("roc_auc"))).alias("best_tx_auc"))
    f = folds.agg(F.avg("roc_auc").alias("fold_auc_mean"), F.stddev_samp("roc_auc").alias("fold_auc_std"))
    s = signals.agg(F.count_if(F.col("recommended_action") == "Upsell").alias("n_upsell"))
    return e.crossJoin(f).crossJoin(s)


# The feature dictionary (name, description, source).
FEATURE_DICTIONARY = [
    ("tx_count", "Number of transactions in the observation window", "transactions"),
    ("tx_total", "Total transaction amount", "transactions"),
    ("tx_mean", "Mean transaction amount", "transactions"),
    ("tx_median", "Median transaction amount", "transactions"),
    ("tx_std", "Standard deviation of transaction amount", "transactions"),
    ("tx_min", "Smallest transaction amount", "transactions"),
    ("tx_max", "Largest transaction amount", "transactions"),
    ("tx_cv", "Coefficient of variation of amount (std / max(mean, 1))", "transactions"),
    ("tx_recency", "Days since the last transaction at the window end", "transactions"),
    ("tx_span", "Days between first and last transaction (at least 1)", "transactions"),
    ("tx_freq", "Transactions per day of span", "transactions"),
    ("tx_wknd_ratio", "Share of weekend transactions", "transactions"),
    ("tx_count_trend", "Slope of monthly transaction count", "transactions"),
    ("tx_amt_trend", "Slope of monthly amount relative to its mean", "transactions"),
    ("tx_max_gap", "Longest gap in days between transactions", "transactions"),
    ("tx_late_ratio", "Late-window rate over early-window rate", "transactions"),
]


def _feature_means(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in cols]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean")) for c in cols])).alias("s")).select("s.*")


def feature_dictionary(spark, mart: DataFrame, types=(), attributes: DataFrame | None = None) -> DataFrame:
    """R-10: every feature of the mart, a share for each of ``types`` and every
    customer attribute included, with its mean (NULL where it is no number)."""
    entries = FEATURE_DICTIONARY + [
        (name, f"Share of transactions of type {t}", "transactions") for t, name in share_names(types).items()]
    means = _feature_means(mart, [f for f, _, _ in entries if f in mart.columns])
    if attributes is not None:
        own = [f for f in attributes.schema.fields if f.name != "customer_id"]
        entries += [(f.name, f"Customer attribute {f.name}", "customers") for f in own]
        numbers = [f.name for f in own if isinstance(f.dataType, NumericType)]
        if numbers:
            means = means.unionByName(_feature_means(attributes, numbers))
    d = spark.createDataFrame(entries, "feature string, description string, source string")
    return d.join(F.broadcast(means), "feature", "left")  # a row per feature
