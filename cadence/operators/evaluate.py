"""Evaluation from one score table (E-1 ... E-14, H-1, H-2).

Rank metrics never sort the scored rows into one task: the rows collapse to
``(score, pos, neg)`` and the running sums by descending score come from the
distributed ``running_totals``. The threshold sweep buckets scores once on
the 0.01 grid and suffix-sums <= 101 bucket rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.columns import clip01
from cadence.functions.ordered import running_totals
from cadence.session import materialize


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def score_table(df: DataFrame, label: str = "label", score: str = "score",
                by: list[str] | None = None) -> DataFrame:
    """(score, pos, neg): one row per distinct score (per group)."""
    y = F.col(label).cast("long")
    return df.groupBy(*(by or []), F.col(score).alias("score")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))


def cumulative_scores(df: DataFrame, label: str = "label", score: str = "score",
                      by: list[str] | None = None) -> DataFrame:
    """Score table with running ``cum_pos``/``cum_neg`` by descending score,
    restarted in each group of ``by``: groups follow each other in the order, so
    a group's offset is the smallest sum in front of one of its rows."""
    by = by or []
    t = score_table(df, label, score, by)
    c = running_totals(t, [*[F.col(g).asc() for g in by], F.col("score").desc()],
                       ["pos", "neg"], row_number_col=None)
    if not by:
        return c
    offs = c.groupBy(*_group(by)).agg(F.min(F.col("cum_pos") - F.col("pos")).alias("_op"),
                                      F.min(F.col("cum_neg") - F.col("neg")).alias("_on"))
    return (c.join(_few(offs), _same_group(c, offs, by))
             .withColumn("cum_pos", F.col("cum_pos") - F.col("_op"))
             .withColumn("cum_neg", F.col("cum_neg") - F.col("_on"))
             .drop("_op", "_on", *[f"_{g}" for g in by]))


#: Rows of a table of groups that is broadcast (a count decides).
MAX_GROUPS = 10_000


def _group(by: list[str]) -> list[Column]:
    return [F.col(g).alias(f"_{g}") for g in by]


def _same_group(rows: DataFrame, groups: DataFrame, by: list[str]) -> Column:
    cond = F.lit(True)
    for g in by:
        cond = cond & rows[g].eqNullSafe(groups[f"_{g}"])
    return cond


def _few(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if groups.limit(MAX_GROUPS + 1).count() <= MAX_GROUPS else groups


def rank_metrics(df: DataFrame, label: str = "label", score: str = "score",
                 by: list[str] | None = None) -> DataFrame:
    """E-1 ROC AUC (ties count one half) and E-2 average precision (step sum).
    One row (per group): n, n_pos, roc_auc, pr_auc (NULL when a class is missing)."""
    return _rank(cumulative_scores(df, label, score, by), by)


def _rank(c: DataFrame, by: list[str] | None) -> DataFrame:
    P, N = F.sum("pos"), F.sum("neg")
    auc_num = F.sum(F.col("neg") * ((F.col("cum_pos") - F.col("pos")) + F.col("pos") / 2.0))
    ap_num = F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))))
    g = c.groupBy(*(by or []))
    return g.agg(
        (P + N).alias("n"), P.alias("n_pos"),
        F.when((P > 0) & (N > 0), auc_num / (P * N)).alias("roc_auc"),
        F.when(P > 0, ap_num / P).alias("pr_auc"))


def brier(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """E-3: mean squared error of the probability."""
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label).cast("double"), 2)).alias("brier"))


def confusion_counts(df: DataFrame, threshold: float | Column, label: str = "label",
                     score: str = "score") -> DataFrame:
    """tp, fp, fn, tn at ``score >= threshold`` (X-24)."""
    y = F.col(label) == 1
    hat = F.col(score) >= (threshold if isinstance(threshold, Column) else F.lit(float(threshold)))
    return df.agg(F.count_if(hat & y).alias("tp"), F.count_if(hat & ~y).alias("fp"),
                  F.count_if(~hat & y).alias("fn"), F.count_if(~hat & ~y).alias("tn"))


def prf_columns(tp: Column, fp: Column, fn: Column) -> list[Column]:
    p = _ratio(tp, tp + fp)
    r = _ratio(tp, tp + fn)
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return [p.alias("precision"), r.alias("recall"), f1.alias("f1")]


def threshold_metrics(df: DataFrame, threshold: float = 0.5, label: str = "label",
                      score: str = "score") -> DataFrame:
    """E-4 / E-12: precision, recall, F1 (0 when undefined) and flagged count."""
    c = confusion_counts(df, threshold, label, score)
    return c.select(F.lit(float(threshold)).alias("threshold"),
                    *prf_columns(F.col("tp"), F.col("fp"), F.col("fn")),
                    (F.col("tp") + F.col("fp")).alias("n_flagged"))


def top_decile(df: DataFrame, label: str = "label", score: str = "score",
               key: str = "customer_id") -> DataFrame:
    """E-5 / E-6: precision@k, recall@k and lift for k = max(n // 10, 1);
    ties broken by key ascending (X-17). One row, also for no input."""
    one = df.select(F.lit(1).alias("_all"), key, label, score)
    found = _top_decile(one, cumulative_scores(one, label, score, ["_all"]), label, score, key, ["_all"])
    spine = df.sparkSession.range(1).select(F.lit(1).alias("_all"))
    return spine.join(found, "_all", "left").select(
        F.coalesce("k", F.lit(1)).cast("long").alias("k"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("precision_at_k", "recall_at_k", "lift_top_decile")])


def _top_decile(df: DataFrame, c: DataFrame, label: str, score: str, key: str, by: list[str]) -> DataFrame:
    """Per group: the score table ``c`` names the score of the k-th row and the
    positives above it; only the rows of that score are ranked by key."""
    tot = c.groupBy(*_group(by)).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("n_pos"))
    tot = tot.withColumn("k", F.greatest(F.floor(F.col("n") / 10), F.lit(1)).cast("long"))
    upto = F.col("cum_pos") + F.col("cum_neg")
    before = upto - F.col("pos") - F.col("neg")
    edge = materialize(
        c.join(_few(tot), _same_group(c, tot, by)).where((upto >= F.col("k")) & (before < F.col("k")))
        .select(*[f"_{g}" for g in by], "n", "n_pos", "k", F.col("score").alias("_edge"),
                (F.col("cum_pos") - F.col("pos")).alias("_above"), (F.col("k") - before).alias("_need")))
    tied = df.join(_few(edge), _same_group(df, edge, by) & df[score].eqNullSafe(edge["_edge"]))
    ranked = running_totals(
        tied.select(*by, F.col(key).alias("_key"), F.col(label).cast("long").alias("_y"), "_need"),
        [*[F.col(g).asc() for g in by], F.col("_key").asc()], [], row_number_col="rn")
    first = ranked.groupBy(*_group(by)).agg(F.min("rn").alias("_first"))
    taken = (ranked.join(_few(first), _same_group(ranked, first, by)).where(F.col("rn") - F.col("_first") < F.col("_need"))
             .groupBy(*by).agg(F.sum("_y").alias("_taken")))
    top_pos = F.col("_above") + F.coalesce("_taken", F.lit(0))
    p_at_k = top_pos / F.col("k")
    return edge.join(taken, _same_group(taken, edge, by), "left").select(
        *[F.col(f"_{g}").alias(g) for g in by], "k",
        p_at_k.alias("precision_at_k"),
        (top_pos / F.greatest(F.col("n_pos"), F.lit(1))).alias("recall_at_k"),
        (p_at_k / F.greatest(F.col("n_pos") / F.col("n"), F.lit(1e-9))).alias("lift_top_decile"))


def evaluation_table(scored: dict[tuple[str, str], DataFrame], label: str = "label",
                     score: str = "score", key: str = "customer_id", threshold: float = 0.5) -> DataFrame:
    """E-7: one metric row per (setup, model), setup asc, AUC desc: ROC AUC, PR
    AUC, Brier, F1/precision/recall at the threshold, P@10%, R@10% and lift. All
    configurations go through one long frame, whose scores are computed once."""
    by = ["setup", "model"]
    rows = None
    for (s, m), df in scored.items():
        part = df.select(F.lit(s).alias("setup"), F.lit(m).alias("model"), key, label, score)
        rows = part if rows is None else rows.unionByName(part)
    rows = materialize(rows)
    c = cumulative_scores(rows, label, score, by)
    y, hat = F.col(label) == 1, F.col(score) >= F.lit(float(threshold))
    counts = rows.groupBy(*by).agg(
        F.avg(F.pow(F.col(score) - F.col(label).cast("double"), 2)).alias("brier"),
        F.count_if(hat & y).alias("tp"), F.count_if(hat & ~y).alias("fp"), F.count_if(~hat & y).alias("fn"))
    t = counts.select(*by, "brier", *prf_columns(F.col("tp"), F.col("fp"), F.col("fn")))
    k = _top_decile(rows, c, label, score, key, by).drop("k")
    spine = rows.sparkSession.createDataFrame(list(scored), "setup string, model string")
    out = spine.join(_rank(c, by).drop("n", "n_pos"), by, "left").join(t, by, "left").join(k, by, "left")
    none = ["f1", "precision", "recall", "precision_at_k", "recall_at_k", "lift_top_decile"]
    return (out.select(*by, "roc_auc", "pr_auc", "brier", *[F.coalesce(x, F.lit(0.0)).alias(x) for x in none])
            .orderBy(F.col("setup").asc(), F.col("roc_auc").desc(), F.col("model").asc()))


def _grid_bucket(score: Column) -> Column:
    """Largest m in [0, 100] with m / 100.0 <= score (exact on the double grid)."""
    s = clip01(score)
    m0 = F.floor(s * 100).cast("int")
    up = F.when(s >= (m0 + 1) / F.lit(100.0), 1).otherwise(0)
    down = F.when(s < m0 / F.lit(100.0), 1).otherwise(0)
    return m0 + up - down


def threshold_sweep(df: DataFrame, label: str = "label", score: str = "score",
                    lo: int = 5, hi: int = 95) -> DataFrame:
    """E-8: precision / recall / F1 at thresholds (lo..hi)/100. Scores are
    bucketed once; the sweep runs on <= 101 bucket rows. Scores below 0 never
    pass a threshold, scores above 1 always do."""
    spark: SparkSession = df.sparkSession
    y = F.col(label).cast("long")
    b = (F.when(F.col(score) < 0, F.lit(-1)).when(F.col(score) > 1, F.lit(101))
         .otherwise(_grid_bucket(F.col(score))))
    buckets = df.groupBy(b.alias("b")).agg(F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg"))
    th = spark.range(lo, hi + 1).select(F.col("id").cast("int").alias("m"))
    # every threshold row sees all (<= 103) bucket rows: totals come from the same aggregate
    j = th.crossJoin(F.broadcast(buckets)).groupBy("m").agg(
        F.sum(F.when(F.col("b") >= F.col("m"), F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("b") >= F.col("m"), F.col("neg")).otherwise(0)).alias("fp"),
        F.sum("pos").alias("P"))
    j = j.withColumn("fn", F.col("P") - F.col("tp"))
    return j.select((F.col("m") / F.lit(100.0)).alias("threshold"),
                    *prf_columns(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """E-9: first maximum of F1 (lowest threshold wins ties, X-23)."""
    return sweep.orderBy(F.col("f1").desc(), F.col("threshold").asc()).limit(1).select(
        "threshold", "f1")


def classification_report(df: DataFrame, threshold: float, label: str = "label",
                          score: str = "score") -> DataFrame:
    """E-10: per-class precision/recall/F1/support, accuracy, macro and
    weighted averages (accuracy sits in the F1 column, as printed)."""
    c = confusion_counts(df, threshold, label, score)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1, f1 = prf_columns(tp, fp, fn)
    p0, r0, f0 = prf_columns(tn, fn, fp)
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    acc = _ratio(tp + tn, n)
    names = ["class", "precision", "recall", "f1", "support"]

    def row(*vals):
        return F.struct(*[v.alias(n) for v, n in zip(vals, names)])

    none = F.lit(None).cast("double")
    rows = c.select(F.array(
        row(F.lit("0"), p0, r0, f0, s0),
        row(F.lit("1"), p1, r1, f1, s1),
        row(F.lit("accuracy"), none, none, acc, n),
        row(F.lit("macro avg"), (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row(F.lit("weighted avg"), _ratio(p0 * s0 + p1 * s1, n), _ratio(r0 * s0 + r1 * s1, n),
            _ratio(f0 * s0 + f1 * s1, n), n),
    ).alias("r"))
    return rows.select(F.explode("r").alias("r")).select("r.*")


def confusion_matrix(df: DataFrame, threshold: float = 0.5, label: str = "label",
                     score: str = "score") -> DataFrame:
    """E-11: 2x2 counts, zero-filled (four-row spine)."""
    spark = df.sparkSession
    spine = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "actual int, predicted int")
    hat = (F.col(score) >= F.lit(float(threshold))).cast("int")
    counts = df.groupBy(F.col(label).cast("int").alias("actual"), hat.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    return spine.join(counts, ["actual", "predicted"], "left").fillna(0, subset=["n"])


def sanity_check(scored: DataFrame, external: DataFrame, label: str = "label",
                 score: str = "score", ext_score: str = "sanity_score",
                 key: str = "customer_id") -> DataFrame:
    """E-13: Pearson correlation of model and external score, AUC of both."""
    j = scored.select(key, label, score).join(external.select(key, ext_score), key)
    corr = j.agg(F.corr(score, ext_score).alias("pearson"))
    a1 = rank_metrics(j, label, score).select(F.col("roc_auc").alias("auc_model"))
    a2 = rank_metrics(j, label, ext_score).select(F.col("roc_auc").alias("auc_external"))
    return corr.crossJoin(a1).crossJoin(a2)


def setup_comparison(evaluation: DataFrame, full: str = "Full", tx: str = "Tx-strict") -> DataFrame:
    """E-14: AUC grid setup x model, best per setup and the Full - Tx gap."""
    models = sorted({r["model"] for r in evaluation.select("model").distinct().collect()})
    grid = evaluation.groupBy("setup").pivot("model", models).agg(F.first("roc_auc"))
    best = evaluation.groupBy("setup").agg(F.max("roc_auc").alias("best_auc"))
    g = grid.join(best, "setup")
    gap = g.agg(
        (F.max(F.when(F.col("setup") == full, F.col("best_auc")))
         - F.max(F.when(F.col("setup") == tx, F.col("best_auc")))).alias("gap_full_minus_tx"))
    return g.crossJoin(gap)


def roc_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """H-1: (fpr, tpr) at every distinct score, plus the origin."""
    c = cumulative_scores(df, label, score)
    tot = c.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    pts = c.crossJoin(F.broadcast(tot)).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_neg"), F.col("N")).alias("fpr"),
        _ratio(F.col("cum_pos"), F.col("P")).alias("tpr"))
    origin = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def pr_points(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """H-2: (recall, precision) at every distinct score, plus (0, 1)."""
    c = cumulative_scores(df, label, score)
    tot = c.agg(F.sum("pos").alias("P"))
    pts = c.crossJoin(F.broadcast(tot)).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_pos"), F.col("P")).alias("recall"),
        _ratio(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"))
    end = df.sparkSession.createDataFrame([(None, 0.0, 1.0)],
                                          "threshold double, recall double, precision double")
    return pts.unionByName(end)
