"""Registered model, calibration and end-to-end queries (M-*, C-*, V-4, S-4/S-5).

Model fits are MLlib results: the driver gets rows-only checks for them. The
stages of a run are stored under a fingerprint of its inputs and parameters, so
each query gives the same result alone and in any order, and a stage is fitted
by the first query that needs it.
"""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from cadence.operators import calibrate as C
from cadence.operators import models as M
from cadence.operators import ranking as RK
from cadence.operators import walkforward as V
from cadence.plans.common import round_doubles
from cadence.plans.pipeline import ModelRun, calibration_properties, score_properties
from cadence.session import ensure_checkpoint_dir
from cadence.sources import load_result, save_result

def run_for(spark, d) -> ModelRun:
    return ModelRun(spark, d)


def _r(f):
    return lambda spark, d: round_doubles(f(spark, d))


def _weights(spark, d):
    from cadence.plans.catalog_prep import split_frame
    tr = split_frame(spark, d, columns=[]).where(F.col("split") == "train")
    return M.class_weights(tr, "future_disengaged").select("customer_id", "w_balanced", "w_pos")


def _best(spark, d):
    r = run_for(spark, d)
    r.both_grids()
    return M.best_model(r.evaluation("risk", "val")).unionByName(M.best_model(r.evaluation("growth", "val")))


def _reliability(spark, d):
    rr, bp = run_for(spark, d).calibrated_test()
    return C.reliability_curve(rr, "label", "calibrated").select(F.lit("Redemption Risk").alias("signal"), "*") \
        .unionByName(C.reliability_curve(bp, "label", "calibrated").select(F.lit("Buy Propensity").alias("signal"), "*"))


def _reliability_standin(spark, d):
    from cadence.plans.catalog_eval import scored_split
    return C.reliability_curve(scored_split(spark, d))


def _summary_standin(spark, d):
    from cadence.plans.catalog_eval import scored_split
    return C.score_summary(scored_split(spark, d), "score")


def _summary(spark, d):
    s = run_for(spark, d).scores()
    return C.score_summary(s, "rr_raw").select(F.lit("rr").alias("signal"), "*").unionByName(
        C.score_summary(s, "bp_raw").select(F.lit("bp").alias("signal"), "*"))


def _save_load(spark, d):
    """S-4 / S-5: write the signal table under the shared checkpoint folder
    and read it back."""
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "results", "signals")
    save_result(run_for(spark, d).signals(), path)
    return load_result(spark, path)


def attribution(spark, d, algo: str = "GBT", run: ModelRun | None = None):
    """M-8: attribution of the Full risk model on every test row."""
    from cadence.operators import attribution as A
    r = run or run_for(spark, d)
    fit = r.configuration("risk", "Full", algo)[0]
    frame, names, _ = r.prepared("Full", "future_disengaged")
    rows = frame.where(F.col("split") == "test")
    if algo == "LR":
        return A.linear_attribution(fit.model, frame.where(F.col("split") == "train"), rows, names)
    return A.tree_attribution(fit.model, rows, names)


def _attr_summary(algo):
    def q(spark, d):
        from cadence.operators import attribution as A
        return A.attribution_summary(attribution(spark, d, algo))
    return q


def _attr_top5(spark, d):
    from cadence.operators import attribution as A
    long = attribution(spark, d, "GBT")
    return A.top_feature_values(long, A.attribution_summary(long), 5)


def _model_sweep(spark, d):
    from cadence.operators import evaluate as E
    return E.threshold_sweep(run_for(spark, d).best("risk")[1])


def _model_report(spark, d):
    from cadence.operators import evaluate as E
    r = run_for(spark, d)
    return E.classification_report(r.best("risk")[2], r.threshold())


def _model_sanity(spark, d):
    from cadence.operators import evaluate as E
    from cadence.sources import customers
    return E.sanity_check(run_for(spark, d).best("risk")[2], customers(spark, d))


def _model_confusion(spark, d):
    from cadence.operators import evaluate as E
    return E.confusion_matrix(run_for(spark, d).best("risk")[2], 0.5)


def _model_setups(spark, d):
    from cadence.operators import evaluate as E
    return E.setup_comparison(run_for(spark, d).evaluation("risk", "test"))


def _best_standin(spark, d):
    from cadence.plans.catalog_eval import _grid
    return M.best_model(_grid(spark, d))


def _brier_standin(spark, d):
    """C-3 with the squared stand-in score as the calibrated one."""
    from cadence.plans.catalog_eval import scored_split
    s = scored_split(spark, d).withColumn("calibrated", F.col("score") * F.col("score"))
    return C.brier_comparison({"recency": (s, "label", "score", "calibrated")})


def _attribution_sums(spark, d):
    """M-8: rows whose contributions and bias do not add up to the margin."""
    r = run_for(spark, d)
    sums = attribution(spark, d, "GBT", r).groupBy("customer_id").agg(F.sum("contribution").alias("total"))
    scored = r.configuration("risk", "Full", "GBT")[2]
    off = F.col("total").isNull() | (F.abs(F.col("total") - F.col("margin")) > 1e-6)
    return scored.join(sums, "customer_id", "left").agg(F.count(F.lit(1)).alias("n"), F.count_if(off).alias("n_off"))


def _model_kpis(spark, d):
    from cadence.operators import report as R
    r = run_for(spark, d)
    with ThreadPoolExecutor(2) as ex:  # the grids and the folds share no stage
        folds, signals = ex.submit(r.walk_forward), ex.submit(r.signals)
        found = signals.result()
        return R.headline_kpis(r.evaluation("risk", "test"), folds.result(), found)


def _model_highlights(spark, d):
    from cadence.operators import report as R
    return R.metric_highlights(run_for(spark, d).evaluation("risk", "test"))


def model_queries():
    return {
        "m4_class_weights": _r(_weights),
        "m5_risk_model_grid": _r(lambda s, d: run_for(s, d).evaluation("risk", "test")),
        "m6_feature_importance": _r(lambda s, d: M.feature_importance(
            s, run_for(s, d).configuration("risk", "Full", "GBT")[0])),
        "m7_lr_coefficients": _r(lambda s, d: M.coefficients(s, run_for(s, d).configuration("risk", "Full", "LR")[0])),
        "m8_attribution_gbt": _r(_attr_summary("GBT")),
        "m8_attribution_lr": _r(_attr_summary("LR")),
        "m8_attribution_top5_rows": _r(_attr_top5),
        "e8_threshold_sweep_model": _r(_model_sweep),
        "e10_classification_report_model": _r(_model_report),
        "e11_confusion_matrix_model": _model_confusion,
        "e13_sanity_check_model": _r(_model_sanity),
        "e14_setup_comparison_model": _r(_model_setups),
        "r9_metric_highlights_model": _r(_model_highlights),
        "m9_growth_model_grid": _r(lambda s, d: run_for(s, d).evaluation("growth", "test")),
        "m10_best_models": _r(_best),
        "m10_best_standin": _r(_best_standin),
        "m5_m9_score_properties": lambda s, d: score_properties(run_for(s, d)),
        "m8_attribution_sums": _attribution_sums,
        "c2_calibration_properties": lambda s, d: calibration_properties(run_for(s, d)),
        "c3_brier_standin": _r(_brier_standin),
        "c1_c2_calibrated_scores": _r(lambda s, d: run_for(s, d).scores()),
        "c3_brier_comparison": _r(lambda s, d: run_for(s, d).brier_comparison()),
        "c4_reliability_curve": _r(_reliability),
        "c4_reliability_standin": _r(_reliability_standin),
        "c5_score_summary": _r(_summary),
        "c5_score_summary_standin": _r(_summary_standin),
        "v4_walk_forward_gbt": _r(lambda s, d: run_for(s, d).walk_forward()),
        "v6_walk_forward_stability": _r(lambda s, d: V.fold_stability(run_for(s, d).walk_forward())),
        "r1_headline_kpis_model": _r(_model_kpis),
        "pipeline_signals": _r(lambda s, d: run_for(s, d).signals()),
        "pipeline_top_opportunities": _r(lambda s, d: RK.top_opportunities(run_for(s, d).signals())),
        "s4_s5_save_load_signals": _r(_save_load),
    }
