"""Probability calibration (C-1 ... C-5).

Isotonic regression on the validation split of a prefit model. Rows become one
point per distinct score (rows, positives). Points are dealt out by ranges of
the score, and each task pools the adjacent violators of its range exactly (in
integers). Pooling does not depend on its order, so blocks of neighbouring
ranges can be pooled again: as long as a range starts below the end of the one
before - the driver compares one row per range - the blocks, far fewer than the
points, are dealt to half as many ranges and pooled once more. The model is the
table of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.functions.columns import clip01
from cadence.operators.evaluate import brier
from cadence.session import materialize

#: Points (distinct scores) that one task pools at first.
RANGE_POINTS = 200_000
#: Blocks of a model that is applied; labels of n rows have about n^(2/3) different means at most.
MAX_BLOCKS = 2_000_000

_BLOCK = "lo double, hi double, w long, y long"


def pooled(lo: list[float], hi: list[float], w: list[int], y: list[int]) -> tuple[list, list, list, list]:
    """Pool adjacent violators: blocks in order whose means ``y / w`` rise."""
    out_lo: list[float] = []
    out_hi: list[float] = []
    out_w: list[int] = []
    out_y: list[int] = []
    for a, b, n, s in zip(lo, hi, w, y, strict=True):
        while out_w and out_y[-1] * n >= s * out_w[-1]:
            a = out_lo.pop()
            out_hi.pop()
            n, s = n + out_w.pop(), s + out_y.pop()
        out_lo.append(a)
        out_hi.append(b)
        out_w.append(n)
        out_y.append(s)
    return out_lo, out_hi, out_w, out_y


def _pool_ranges(blocks: DataFrame, ranges: int) -> DataFrame:
    """Blocks of each of ``ranges`` score ranges, pooled; ``part`` numbers the ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list, list] = ([], [], [], [])
        for batch in batches:
            more = [batch.column(i).to_pylist() for i in range(4)]
            held = pooled(*[h + m for h, m in zip(held, more, strict=True)])
        types = (pa.float64(), pa.float64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(h, t) for h, t in zip(held, types, strict=True)], names=["lo", "hi", "w", "y"])

    dealt = blocks.repartitionByRange(ranges, "lo") if ranges > 1 else blocks.coalesce(1)
    return materialize(dealt.sortWithinPartitions("lo").mapInArrow(run, _BLOCK).withColumn("part", F.spark_partition_id()))


@dataclass
class IsotonicModel:
    """Blocks ``lo, hi, value`` of a non-decreasing step fit: constant inside a
    block, linear between blocks, clipped outside."""

    blocks: DataFrame

    def knots(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.blocks.limit(MAX_BLOCKS + 1).collect()
        if len(rows) > MAX_BLOCKS:
            raise ValueError(f"the calibrator has more than {MAX_BLOCKS} blocks; round the scores first")
        found = sorted({(x, r["value"]) for r in rows for x in (r["lo"], r["hi"])})
        return np.array([x for x, _ in found]), np.array([v for _, v in found])

    def save(self, path: str) -> str:
        self.blocks.write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsotonicModel:
        return IsotonicModel(spark.read.parquet(path))


def fit_isotonic(scored_val: DataFrame, score: str = "score", label: str = "label",
                 range_points: int = RANGE_POINTS) -> IsotonicModel:
    """C-1: increasing isotonic fit of the 0/1 label on the score; ties are one
    point, rows without score or label do not take part."""
    x = F.col(score).cast("double")
    pts = (scored_val.where(x.isNotNull() & ~F.isnan(x) & F.col(label).isNotNull())
           .groupBy(x.alias("lo")).agg(F.count(F.lit(1)).alias("w"), F.sum(F.col(label).cast("long")).alias("y"))
           .select("lo", F.col("lo").alias("hi"), "w", "y"))
    pts = materialize(pts)
    ranges = max(1, -(-pts.count() // range_points))
    blocks = pts
    while True:
        blocks = _pool_ranges(blocks, ranges)
        ends = blocks.groupBy("part").agg(F.min("lo").alias("at"), F.min_by(F.struct("w", "y"), "lo").alias("first"),
                                          F.max_by(F.struct("w", "y"), "lo").alias("last")).orderBy("at").collect()
        falls = any(p["last"]["y"] * q["first"]["w"] >= q["first"]["y"] * p["last"]["w"]
                    for p, q in zip(ends, ends[1:], strict=False))
        if not falls:
            return IsotonicModel(blocks.select("lo", "hi", (F.col("y") / F.col("w")).alias("value")))
        blocks, ranges = blocks.drop("part"), max(1, ranges // 2)


def apply_isotonic(model: IsotonicModel, scored: DataFrame, score: str = "score", out: str = "calibrated") -> DataFrame:
    """C-2: calibrated probability for every row (clipped to [0, 1]); NULL for
    a NULL score."""
    sent = scored.sparkSession.sparkContext.broadcast(model.knots())

    @F.pandas_udf("double")
    def fitted(x: pd.Series) -> pd.Series:
        at, value = sent.value
        y = np.interp(x.to_numpy(float), at, value) if len(at) else np.full(len(x), np.nan)
        return pd.Series(y).where(x.notna().to_numpy())

    return scored.withColumn(out, clip01(fitted(F.col(score).cast("double"))))


def brier_comparison(rows: dict[str, tuple[DataFrame, str, str, str]]) -> DataFrame:
    """C-3: Brier before / after calibration and the improvement per signal.
    ``rows[signal] = (frame, label, raw_col, calibrated_col)``."""
    out = None
    for sig, (df, label, raw, cal) in rows.items():
        b0 = brier(df, label, raw).withColumnRenamed("brier", "brier_before")
        b1 = brier(df, label, cal).withColumnRenamed("brier", "brier_after")
        r = b0.crossJoin(b1).select(F.lit(sig).alias("signal"), "brier_before", "brier_after",
                                    (F.col("brier_before") - F.col("brier_after")).alias("improvement"))
        out = r if out is None else out.unionByName(r)
    return out


def reliability_curve(df: DataFrame, label: str = "label", score: str = "score",
                      n_bins: int = 10) -> DataFrame:
    """C-4: uniform bins; a probability sits in the bin given by the number of
    inner edges strictly below it (right-closed bins, X-21); non-empty bins."""
    edges = [i * (1.0 / n_bins) for i in range(1, n_bins)]
    b = sum((F.col(score) > F.lit(e)).cast("int") for e in edges)
    return df.groupBy(b.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


def score_summary(df: DataFrame, score: str) -> DataFrame:
    """C-5: min, max and mean of a score column."""
    return df.agg(F.min(score).alias("min"), F.max(score).alias("max"), F.avg(score).alias("mean"))
