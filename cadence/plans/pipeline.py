"""End-to-end model run: mart -> split -> preprocess -> model grid ->
evaluation and threshold -> calibration -> all-customer scores -> signals,
plus walk-forward validation. Frames reused by several jobs are checkpointed
(lineage cut in the shared checkpoint folder); only fits are driver loops.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.config import (
    CustomerMapping, FeatureSpec, ModelParams, ORDERS_FOLDS, ORDERS_FOLDS_START, ORDERS_MAPPING, SignalParams, SplitSpec, TxMapping,
)
from cadence.operators import calibrate as C
from cadence.operators import evaluate as E
from cadence.operators import models as M
from cadence.operators import prep as P
from cadence.operators import quality as Q
from cadence.operators import ranking as RK
from cadence.operators import report as R
from cadence.operators import signals as G
from cadence.operators import split as S
from cadence.operators import walkforward as V
from cadence.operators.features import customer_mart, infer_feature_groups, tx_feature_columns
from cadence.session import materialize, shared_folder
from cadence.sources import customers, load_result, log_profile, log_types, raw_transactions, save_model, save_result, transactions

SETUPS = ("Full", "Tx-strict", "Cust-only")


@dataclass
class RunConfig:
    mapping: TxMapping = ORDERS_MAPPING
    customers: CustomerMapping | None = None   # None: the driver's customer table
    params: ModelParams = field(default_factory=ModelParams)
    signal: SignalParams = field(default_factory=SignalParams)
    split: SplitSpec = field(default_factory=SplitSpec)
    folds: tuple = ORDERS_FOLDS
    folds_start: dt.date = ORDERS_FOLDS_START  # first day that the folds observe
    fold_features: str = "subset"   # "full": every transaction feature in each fold (D-7)
    wf_rounds: int = 200
    select_on: str = "val"          # D-2: "test" reproduces the reference's growth pick
    parallelism: int = 6            # concurrent independent fits (driver threads)
    split_method: str = "hash"      # "exact": per-class proportions, as a stratified split


def setup_columns(setup: str, types, spec: FeatureSpec = FeatureSpec()):
    """F-19: (numeric, ordinal, nominal) columns of a feature setup."""
    tx = tx_feature_columns(types)
    if setup == "Full":
        return list(spec.numeric) + tx, dict(spec.ordinal), list(spec.nominal)
    if setup == "Tx-strict":
        return tx, {}, []
    if setup == "Cust-only":
        return list(spec.numeric), dict(spec.ordinal), list(spec.nominal)
    raise ValueError(setup)


def attributes(spark: SparkSession, sf_dir: str, mapping: CustomerMapping | None = None) -> DataFrame:
    """Key and cleaned attributes of every customer."""
    return Q.clean_customers(customers(spark, sf_dir, mapping), holdout=("sanity_score",))


def attribute_spec(attrs: DataFrame, mapping: CustomerMapping | None = None) -> FeatureSpec:
    """F-17: the attribute groups, by type where a mapping gives no order."""
    if mapping is None:
        return FeatureSpec()
    ordinal = {c: o for c, o in mapping.ordinal.items() if c in attrs.columns}
    nominal = [c for c, t in attrs.dtypes if t == "string" and c != "customer_id" and c not in ordinal]
    groups = infer_feature_groups(attrs, ordinal, nominal)
    return FeatureSpec(tuple(groups["numeric"]), ordinal, tuple(nominal))


def base_frame(spark: SparkSession, sf_dir: str, cfg: RunConfig) -> DataFrame:
    """Mart + labels + split + cleaned customer attributes, materialised."""
    m = cfg.mapping
    attrs = attributes(spark, sf_dir, cfg.customers)
    types, heaviest = log_profile(spark, sf_dir, m)
    mart = customer_mart(attrs, transactions(spark, sf_dir, m), m.windows, types, heaviest=heaviest)
    mart = S.assign_split(mart, cfg.split, label="future_disengaged", method=cfg.split_method)
    return materialize(mart.join(attrs, "customer_id", "inner"))


def fit_setup(base: DataFrame, setup: str, types, spec: FeatureSpec = FeatureSpec()) -> P.Preprocessor:
    """P-9: the setup's preprocessor, fitted on train."""
    return P.fit_preprocessor(base.where(F.col("split") == "train"), *setup_columns(setup, types, spec))


def apply_setup(pre: P.Preprocessor, base: DataFrame, label: str) -> DataFrame:
    """P-10: all rows transformed and assembled: ``customer_id, split, label, features``."""
    x = pre.transform(base.withColumn("label", F.col(label).cast("double")), keep=["customer_id", "split", "label"])
    return P.assemble(x, pre.output_names).select("customer_id", "split", "label", "features")


def prepare(base: DataFrame, setup: str, label: str, types, spec: FeatureSpec = FeatureSpec()):
    """P-9 / P-10 at once: (frame, names, preprocessor)."""
    pre = fit_setup(base, setup, types, spec)
    return materialize(apply_setup(pre, base, label)), pre.output_names, pre


def _eval_table(preds: dict, which: int) -> DataFrame:
    return E.evaluation_table({k: v[which] for k, v in preds.items()})


def _pick(evaluation: DataFrame, setup: str) -> str:
    return M.best_model(evaluation.where(F.col("setup") == setup)).first()["model"]


def _calib_input(fitted: M.Fitted, scored: DataFrame) -> DataFrame:
    """LR is calibrated on its margin, trees on probabilities."""
    return scored.withColumn("cal_x", F.col("margin") if fitted.algo == "LR" else F.col("score"))


def run_fingerprint(spark: SparkSession, sf_dir: str, cfg: RunConfig) -> str:
    """Identifies a run: counts and hash sums of the mapped inputs (one read of
    each, whatever their files are), all parameters, and the versions."""
    seen = []
    for df in (raw_transactions(spark, sf_dir, cfg.mapping), customers(spark, sf_dir, cfg.customers)):
        r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(20,0)")).alias("h")).first()
        seen.append((df.schema.simpleString(), r["n"], str(r["h"])))
    said = repr((seen, sorted((k, repr(v)) for k, v in vars(cfg).items() if k != "parallelism"), RUN_FORMAT, spark.version))
    return hashlib.sha256(said.encode()).hexdigest()[:32]


#: Part of a run's fingerprint; to be raised when stored stages change.
RUN_FORMAT = 1


class RunStore:
    """Finished stages of a run, in a folder that outlives the process: tables as
    Parquet, models as MLlib folders, each with a marker written last, so an
    interrupted stage is computed again. An instance opens a stage once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._locks: dict[str, threading.Lock] = {}
        self._open: dict[str, object] = {}

    def _marker(self, name: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.done")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def stage(self, name: str, write, read):
        """``read(path)`` of a stage, after ``write(path)`` if it is not finished."""
        path = f"{self.folder}/{name}"
        with self._locks.setdefault(name, threading.Lock()):
            if name not in self._open:
                fs, marker = self._marker(name)
                if not fs.exists(marker):
                    write(path)
                    fs.create(marker, True).close()
                self._open[name] = read(path)
            return self._open[name]

    def finished(self, name: str) -> bool:
        fs, marker = self._marker(name)
        return name in self._open or fs.exists(marker)

    def table(self, name: str, make) -> DataFrame:
        return self.stage(name, lambda p: make().write.mode("overwrite").parquet(p), self.spark.read.parquet)

    def text(self, name: str, make) -> str:
        return self.stage(name, lambda p: self.spark.createDataFrame([(make(),)], "text string").write.mode("overwrite").parquet(p),
                          lambda p: self.spark.read.parquet(p).first()["text"])


class ModelRun:
    """Stages of the model run. Each is computed once for the same inputs and
    parameters and kept in the run's folder (``runs/<fingerprint>`` in the
    shared checkpoint folder, or ``folder``); a later instance, in this process
    or another, reads it."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: RunConfig = RunConfig(), folder: str | None = None):
        self.spark, self.sf_dir, self.cfg = spark, sf_dir, cfg
        if folder is None:
            folder = os.path.join(shared_folder(spark), "runs", run_fingerprint(spark, sf_dir, cfg))
        self.store = RunStore(spark, folder)
        self._fits = threading.Lock()

    @property
    def base(self) -> DataFrame:
        return self.store.table("base", lambda: base_frame(self.spark, self.sf_dir, self.cfg))

    @property
    def types(self) -> tuple[str, ...]:
        return tuple(json.loads(self.store.text("types", lambda: json.dumps(
            log_types(self.spark, self.sf_dir, self.cfg.mapping)))))

    @property
    def spec(self) -> FeatureSpec:
        return attribute_spec(attributes(self.spark, self.sf_dir, self.cfg.customers), self.cfg.customers)

    def prepared(self, setup: str, label: str):
        """(frame, feature names, preprocessor) of a setup."""
        pre = P.Preprocessor.from_json(self.store.text(f"preprocessor-{setup}-{label}", lambda: fit_setup(
            self.base, setup, self.types, self.spec).to_json()))
        frame = self.store.table(f"prepared-{setup}-{label}", lambda: apply_setup(pre, self.base, label))
        return frame, pre.output_names, pre

    def fitted(self, setup: str, algo: str, label: str, model=None) -> M.Fitted:
        """A configuration's model; ``model`` is stored if it is given and none is yet."""
        frame, names, _ = self.prepared(setup, label)

        def write(path: str) -> None:
            train = frame.where(F.col("split") == "train")
            save_model(model or M.fit(train, algo, self.cfg.params, names=names, setup=setup).model, path)

        return M.Fitted(setup, algo, self.store.stage(f"model-{setup}-{algo}-{label}", write, M.LOADERS[algo].load), names)

    def _configuration(self, setup: str, algo: str, label: str):
        fit = self.fitted(setup, algo, label)

        def scored() -> DataFrame:
            frame = self.prepared(setup, label)[0].where(F.col("split").isin("val", "test"))
            return M.predict(fit, frame, also=["split"])

        rows = self.store.table(f"scored-{setup}-{algo}-{label}", scored)
        val, test = (rows.where(F.col("split") == p).drop("split") for p in ("val", "test"))
        return fit, val, test

    def _boosted_together(self, cells: list[tuple[str, str, str]]) -> list:
        """The boosted models among the cells that are not stored, if they have so
        many rows that they are better grown together."""
        new = [c for c in cells if c[1] == "GBT" and not self.store.finished("model-{}-{}-{}".format(*c))]
        if len(new) < 2:
            return []
        trains = [self.prepared(s, label)[0].where(F.col("split") == "train") for s, _, label in new]
        return [(c, m) for c, m in zip(new, M.fit_together(trains, self.cfg.params), strict=True) if m is not None]

    def _cells(self, cells: list[tuple[str, str, str]]):
        """Every (setup, algorithm, label) as (model, scored val, scored test).
        Fits that are not stored yet are submitted from ``parallelism`` driver
        threads (as MLlib's tuning does). A boosted model is a long chain of
        short jobs and gets a thread of its own, so the chains overlap (with many
        rows they share their jobs and one thread); forests, whose rows carry a
        count per tree, follow each other, as linear models do."""
        frames = list(dict.fromkeys((s, label) for s, _, label in cells))
        lanes = [lane for lane in ([c for c in cells if c[1] == a] for a in M.ALGOS if a != "GBT") if lane]
        boosted = [c for c in cells if c[1] == "GBT"]
        with self._fits, ThreadPoolExecutor(max(1, min(self.cfg.parallelism, len(lanes) + len(boosted)))) as ex:
            list(ex.map(lambda f: self.prepared(*f), frames))
            begun = [ex.submit(lambda lane: [(c, self._configuration(*c)) for c in lane], lane) for lane in lanes]
            for (setup, algo, label), model in self._boosted_together(boosted):
                self.fitted(setup, algo, label, model)
            begun += [ex.submit(lambda c: [(c, self._configuration(*c))], c) for c in boosted]
            done = [lane.result() for lane in begun]
        found = dict(x for lane in done for x in lane)
        return {c: found[c] for c in cells}

    def _grid(self, setups: tuple[str, ...], label: str):
        return {(s, a): cell for (s, a, _), cell in self._cells([(s, a, label) for s in setups for a in M.ALGOS]).items()}

    def risk_grid(self):
        """M-5: 3 setups x 3 algorithms on the disengagement label."""
        return self._grid(SETUPS, "future_disengaged")

    def growth_grid(self):
        """M-9: the three algorithms on Tx-strict features, growth label."""
        return self._grid(("Tx-strict",), "future_growth")

    def both_grids(self) -> None:
        """M-5 and M-9 for a stage that needs both: all fits overlap."""
        self._cells([(s, a, "future_disengaged") for s in SETUPS for a in M.ALGOS]
                    + [("Tx-strict", a, "future_growth") for a in M.ALGOS])

    def configuration(self, which: str, setup: str, algo: str):
        """One cell of a grid: (model, scored val, scored test)."""
        return self._configuration(setup, algo, "future_disengaged" if which == "risk" else "future_growth")

    def evaluation(self, which: str = "risk", part: str = "test") -> DataFrame:
        """E-7 for the risk or growth grid on val or test."""
        return self.store.table(f"evaluation-{which}-{part}", lambda: _eval_table(
            self.risk_grid() if which == "risk" else self.growth_grid(), 1 if part == "val" else 2))

    def best(self, which: str = "risk"):
        """M-10: chosen model (on validation by default, D-2)."""
        setup = "Full" if which == "risk" else "Tx-strict"
        algo = _pick(self.evaluation(which, "val" if self.cfg.select_on == "val" else "test"), setup)
        return self.configuration(which, setup, algo)

    def threshold(self) -> float:
        """E-9 on the validation predictions of the chosen risk model."""
        return self.store.table("threshold", lambda: E.best_threshold(E.threshold_sweep(self.best("risk")[1]))).first()["threshold"]

    def calibrators(self):
        """C-1: isotonic calibrators for risk and propensity."""
        def one(which: str) -> C.IsotonicModel:
            def write(path: str) -> None:
                self.both_grids()
                fit, val, _ = self.best(which)
                C.fit_isotonic(_calib_input(fit, val), "cal_x").save(path)
            return self.store.stage(f"calibrator-{which}", write, lambda p: C.IsotonicModel.load(self.spark, p))
        with ThreadPoolExecutor(2) as ex:  # beyond the fits the two share no stage
            risk, growth = ex.map(one, ("risk", "growth"))
        return risk, growth

    def calibrated_test(self):
        cr, cb = self.calibrators()
        fr, _, tr = self.best("risk")
        fb, _, tb = self.best("growth")
        return (C.apply_isotonic(cr, _calib_input(fr, tr), "cal_x"),
                C.apply_isotonic(cb, _calib_input(fb, tb), "cal_x"))

    def brier_comparison(self) -> DataFrame:
        """C-3."""
        rr, bp = self.calibrated_test()
        return C.brier_comparison({"Redemption Risk": (rr, "label", "score", "calibrated"),
                                   "Buy Propensity": (bp, "label", "score", "calibrated")})

    def scores(self) -> DataFrame:
        """C-2: calibrated risk and propensity for every customer."""
        def go():
            cr, cb = self.calibrators()
            fr, fb = self.best("risk")[0], self.best("growth")[0]
            rr = C.apply_isotonic(cr, _calib_input(fr, M.predict(fr, self.prepared("Full", "future_disengaged")[0])), "cal_x")
            bp = C.apply_isotonic(cb, _calib_input(fb, M.predict(fb, self.prepared("Tx-strict", "future_growth")[0])), "cal_x")
            return (rr.select("customer_id", F.col("calibrated").alias("rr_raw"))
                    .join(bp.select("customer_id", F.col("calibrated").alias("bp_raw")), "customer_id"))
        return self.store.table("scores", go)

    def signals(self) -> DataFrame:
        """G-1 ... G-8 on the calibrated scores."""
        def go():
            beh = self.base.select("customer_id", "tx_total", *G.ENGAGEMENT_INPUTS)
            return G.signal_table(materialize(beh.join(self.scores(), "customer_id")), self.cfg.signal)
        return self.store.table("signals", go)

    def walk_forward(self) -> DataFrame:
        """V-4."""
        return self.store.table("walk-forward", lambda: walk_forward(self.spark, self.sf_dir, self.cfg))


def model_run(spark: SparkSession, sf_dir: str, cfg: RunConfig = RunConfig()) -> dict[str, DataFrame]:
    """Every result table of a full run."""
    r = ModelRun(spark, sf_dir, cfg)
    r.both_grids()
    _, _, test_rr = r.best("risk")
    rr_cal, bp_cal = r.calibrated_test()
    tables = {
        "risk_eval_test": r.evaluation("risk", "test"),
        "risk_eval_val": r.evaluation("risk", "val"),
        "growth_eval_test": r.evaluation("growth", "test"),
        "threshold_sweep": E.threshold_sweep(r.best("risk")[1]),
        "classification_report": E.classification_report(test_rr, r.threshold()),
        "confusion_matrix": E.confusion_matrix(test_rr, 0.5),
        "feature_importance": M.feature_importance(spark, r.risk_grid()[("Full", "GBT")][0]),
        "lr_coefficients": M.coefficients(spark, r.risk_grid()[("Full", "LR")][0]),
        "brier_comparison": r.brier_comparison(),
        "reliability_rr": C.reliability_curve(rr_cal, "label", "calibrated"),
        "reliability_bp": C.reliability_curve(bp_cal, "label", "calibrated"),
        "scores": r.scores(),
        "signals": r.signals(),
        "top_opportunities": RK.top_opportunities(r.signals()),
        "walk_forward": r.walk_forward(),
        "fold_stability": V.fold_stability(r.walk_forward()),
        "run_summary": R.run_summary(r.base, r.signals(), r.evaluation("risk", "test"), r.evaluation("growth", "test")),
        "features": r.base,
        "splits": r.base.select("customer_id", "split", "future_disengaged", "future_growth"),
        "predictions_risk": _predictions(r.risk_grid()),
        "predictions_growth": _predictions(r.growth_grid()),
        "threshold": spark.createDataFrame([(float(r.threshold()),)], "threshold double"),
        "best_models": spark.createDataFrame(
            [(w, f.setup, f.algo) for w, f in (("risk", r.best("risk")[0]), ("growth", r.best("growth")[0]))],
            "target string, setup string, model string"),
    }
    external = customers(spark, sf_dir, cfg.customers)
    if "sanity_score" in external.columns:
        tables["sanity_check"] = E.sanity_check(test_rr, external)
    return tables


def _predictions(grid: dict) -> DataFrame:
    """Scores of every configuration on the validation and the test part."""
    out = None
    for (setup, algo), (_, val, test) in grid.items():
        for part, df in (("val", val), ("test", test)):
            rows = df.select(F.lit(setup).alias("setup"), F.lit(algo).alias("model"), F.lit(part).alias("split"),
                             "customer_id", "label", "score")
            out = rows if out is None else out.unionByName(rows)
    return out


def walk_forward(spark: SparkSession, sf_dir: str, cfg: RunConfig) -> DataFrame:
    """V-4: per fold, median-impute + standardise on the fold's train part and
    fit boosted trees (``wf_rounds``); evaluate on its 20 % hold-out."""
    m = cfg.mapping
    if not cfg.folds:
        raise ValueError("the walk-forward needs folds")
    last = max(f.obs_end for f in cfg.folds)
    log = transactions(spark, sf_dir, m, cfg.folds_start, max(f.pred_end for f in cfg.folds))
    who = customers(spark, sf_dir, cfg.customers)
    if cfg.fold_features == "full":
        types, heaviest = log_profile(spark, sf_dir, m, last)
        ff = V.full_fold_frame(spark, log, who, cfg.folds, cfg.folds_start, types, heaviest=heaviest)
    else:
        ff = V.fold_frame(spark, log, who, cfg.folds, cfg.folds_start, log_types(spark, sf_dir, m, last))
    ff = materialize(ff)
    feat = [c for c in ff.columns if c not in ("fold", "customer_id", "obs_count", "fut_count",
                                                "future_disengaged")]
    params = ModelParams(**{**cfg.params.__dict__, "gbt_rounds": cfg.wf_rounds})

    def prepared(f):
        fold_rows = ff.where(F.col("fold") == f.fold)
        if cfg.split_method == "exact":
            d = S.assign_split(fold_rows, SplitSpec(cfg.split.seed, 80, 0), label="future_disengaged",
                               method="exact").withColumn(
                "split", F.when(F.col("split") == "train", "train").otherwise("test"))
        else:
            d = S.holdout_split(fold_rows, cfg.split.seed, 20)
        pre = P.fit_preprocessor(d.where(F.col("split") == "train"), feat, {}, [])
        x = P.assemble(pre.transform(d.withColumn("label", F.col("future_disengaged").cast("double")),
                                     keep=["customer_id", "split", "label"]), pre.output_names)
        return f, d, x, pre.output_names

    def one(ready, model):
        f, d, x, names = ready
        if model is None:
            fit = M.fit(x.where(F.col("split") == "train"), "GBT", params, names=names)
        else:
            fit = M.Fitted("", "GBT", model, names)
        test = M.predict(fit, x.where(F.col("split") == "test"))
        r = E.rank_metrics(test).select("roc_auc", "pr_auc").crossJoin(E.brier(test))
        rate = d.agg(F.avg(F.col("future_disengaged").cast("double")).alias("target_rate"))
        return materialize(r.crossJoin(rate).select(F.lit(f.fold).alias("fold"), "*"))

    with ThreadPoolExecutor(max_workers=max(1, min(cfg.parallelism, len(cfg.folds)))) as ex:
        ready = list(ex.map(prepared, cfg.folds))
        models = M.fit_together([x.where(F.col("split") == "train") for _, _, x, _ in ready], params)
        parts = list(ex.map(one, ready, models))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return materialize(rows)


def score_properties(run: ModelRun) -> DataFrame:
    """M-5 / M-9: per configuration and part, the scored customers and how many
    scores are missing or outside [0, 1]."""
    run.both_grids()
    both = _predictions(run.risk_grid()).select(F.lit("risk").alias("target"), "*").unionByName(
        _predictions(run.growth_grid()).select(F.lit("growth").alias("target"), "*"))
    return both.groupBy("target", "setup", "model", "split").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("n_customers"),
        F.sum("label").alias("n_pos"),
        F.count_if(F.col("score").isNull() | ~F.col("score").between(0, 1)).alias("n_bad"))


def calibration_properties(run: ModelRun) -> DataFrame:
    """C-2: per signal, the test rows, calibrated scores outside [0, 1], and
    places where they fall while the raw score rises (between the 101 cells of
    the raw score)."""
    out = None
    for signal, df in zip(("risk", "growth"), run.calibrated_test(), strict=True):
        cells = df.groupBy(F.floor(F.col("score") * 100).alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("calibrated").alias("lo"), F.max("calibrated").alias("hi"),
            F.count_if(F.col("calibrated").isNull() | ~F.col("calibrated").between(0, 1)).alias("bad"))
        falls = F.col("lo") < F.lag("hi").over(Window.partitionBy(F.lit(signal)).orderBy("cell")) - 1e-12
        one = cells.withColumn("falls", falls).agg(
            F.sum("n").alias("n"), F.sum("bad").alias("n_bad"), F.count_if("falls").alias("n_falls"))
        one = one.select(F.lit(signal).alias("signal"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def save_run(run: ModelRun, out_dir: str) -> dict[str, str]:
    """S-4: write every result table of a run as Parquet and every fitted
    model as an MLlib model folder (plus the preprocessors as JSON) under
    ``out_dir`` (shared storage on a cluster)."""
    paths: dict[str, str] = {}
    for name, df in model_run(run.spark, run.sf_dir, run.cfg).items():
        paths[name] = save_result(df, os.path.join(out_dir, "tables", name))
    for (setup, algo), (fitted, _, _) in run.risk_grid().items():
        paths[f"model_risk_{setup}_{algo}"] = save_model(
            fitted.model, os.path.join(out_dir, "models", "risk", setup, algo))
    for (setup, algo), (fitted, _, _) in run.growth_grid().items():
        paths[f"model_growth_{setup}_{algo}"] = save_model(
            fitted.model, os.path.join(out_dir, "models", "growth", setup, algo))
    cr, cb = run.calibrators()
    paths["calibrator_risk"] = cr.save(os.path.join(out_dir, "models", "calibrator", "risk"))
    paths["calibrator_growth"] = cb.save(os.path.join(out_dir, "models", "calibrator", "growth"))
    pre = {f"{s}:{lab}": run.prepared(s, lab)[2].to_json()
           for s, lab in [(s, "future_disengaged") for s in SETUPS] + [("Tx-strict", "future_growth")]}
    meta = run.spark.createDataFrame(list(pre.items()), "setup string, preprocessor string")
    paths["preprocessors"] = save_result(meta, os.path.join(out_dir, "tables", "preprocessors"))
    return paths


class SavedRun:
    """S-5: what :func:`save_run` wrote, read back to look up tables and to
    score frames that the run has not seen."""

    def __init__(self, spark: SparkSession, out_dir: str):
        self.spark, self.out_dir = spark, out_dir
        self.chosen = {b["target"]: (b["setup"], b["model"]) for b in self.table("best_models").collect()}

    def table(self, name: str) -> DataFrame:
        return load_result(self.spark, os.path.join(self.out_dir, "tables", name))

    def threshold(self) -> float:
        return self.table("threshold").first()["threshold"]

    def preprocessor(self, setup: str, label: str) -> P.Preprocessor:
        row = self.table("preprocessors").where(F.col("setup") == f"{setup}:{label}").first()
        return P.Preprocessor.from_json(row["preprocessor"])

    def model(self, which: str, setup: str, algo: str):
        return M.LOADERS[algo].load(os.path.join(self.out_dir, "models", which, setup, algo))

    def score(self, frame: DataFrame) -> DataFrame:
        """``customer_id, rr_raw, bp_raw`` of a frame with the run's features:
        the chosen models' scores, calibrated."""
        out = None
        for which, label, name in (("risk", "future_disengaged", "rr_raw"), ("growth", "future_growth", "bp_raw")):
            setup, algo = self.chosen[which]
            pre = self.preprocessor(setup, label)
            x = pre.transform(frame.withColumn("label", F.lit(0.0)), keep=["customer_id", "label"])
            fitted = M.Fitted(setup, algo, self.model(which, setup, algo), pre.output_names)
            scored = M.predict(fitted, P.assemble(x, pre.output_names))
            calibrator = C.IsotonicModel.load(self.spark, os.path.join(self.out_dir, "models", "calibrator", which))
            one = C.apply_isotonic(calibrator, _calib_input(fitted, scored), "cal_x").select(
                "customer_id", F.col("calibrated").alias(name))
            out = one if out is None else out.join(one, "customer_id")
        return out
