"""Preprocessing fitted on the training split only (P-4 ... P-10).

numeric  -> median impute, standardise with the population std (a zero
            scale becomes 1, so a constant train column maps to x - mean)
ordinal  -> fixed category order, unknown / NULL -> -1, unscaled
nominal  -> most-frequent impute (ties -> smallest), one-hot with the first
            (alphabetical) level dropped, unknown -> all zeros

The fitted state is a handful of numbers per column (medians come from the
distributed exact quantile operator, the rest from one aggregate), so it is
kept on the driver as literals and written as JSON next to the models.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.ordered import exact_quantiles

#: Levels of a nominal column; more raise an error.
MAX_LEVELS = 1000
_EPS = 10 * 2.220446049250313e-16


def _colname(prefix: str, value: str) -> str:
    return f"{prefix}_{re.sub(r'[^0-9A-Za-z_]', '_', str(value))}"


def _number(c: str):
    """A numeric column as DOUBLE; NaN is missing, as NULL is."""
    d = F.col(c).cast("double")
    return F.when(~F.isnan(d), d)


@dataclass
class Preprocessor:
    numeric: list[str]
    ordinal: dict[str, list[str]]
    nominal: list[str]
    medians: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)

    @property
    def output_names(self) -> list[str]:
        names = list(self.numeric) + list(self.ordinal)
        for c in self.nominal:
            names += [_colname(c, v) for v in self.categories[c][1:]]
        return names

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """P-10: apply the train-fitted state to any frame."""
        exprs = [F.col(c) for c in (keep or [])]
        for c in self.numeric:
            med = self.medians.get(c)
            x = _number(c) if med is None else F.coalesce(_number(c), F.lit(med))
            exprs.append(((x - F.lit(self.means[c])) / F.lit(self.scales[c])).alias(c))
        for c, order in self.ordinal.items():
            e = F.lit(-1.0)
            for i, v in reversed(list(enumerate(order))):
                e = F.when(F.col(c) == F.lit(v), F.lit(float(i))).otherwise(e)
            exprs.append(e.alias(c))
        for c in self.nominal:
            x = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            for v in self.categories[c][1:]:
                exprs.append((x == F.lit(v)).cast("double").alias(_colname(c, v)))
        return df.select(*exprs)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(s: str) -> "Preprocessor":
        return Preprocessor(**json.loads(s))


def fit_preprocessor(train: DataFrame, numeric: list[str], ordinal: dict[str, list[str]],
                     nominal: list[str]) -> Preprocessor:
    """P-4 ... P-8 / P-9: fit every statistic on the training rows only."""
    p = Preprocessor(list(numeric), {k: list(v) for k, v in ordinal.items()}, list(nominal))
    if numeric:
        for r in exact_quantiles(train, list(numeric), [0.5]).collect():
            p.medians[r["column"]] = r["value"]
        imputed = [F.coalesce(_number(c), F.lit(p.medians.get(c))).alias(c)
                   for c in numeric]
        stats = train.select(*imputed).agg(
            *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(numeric)],
            *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(numeric)]).first()
        for i, c in enumerate(numeric):
            p.means[c] = stats[f"m_{i}"] if stats[f"m_{i}"] is not None else 0.0
            s = stats[f"s_{i}"]
            p.scales[c] = 1.0 if s is None or s < _EPS else s
    for c in nominal:
        # one row per level, up to a stated limit: beyond it a column is no category
        counts = (train.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("v"))
                  .agg(F.count(F.lit(1)).alias("n")).limit(MAX_LEVELS + 1).collect())
        if len(counts) > MAX_LEVELS:
            raise ValueError(f"{c} has more than {MAX_LEVELS} levels; drop or group it first")
        ranked = sorted(counts, key=lambda r: (-r["n"], r["v"]))
        p.modes[c] = ranked[0]["v"] if ranked else ""
        p.categories[c] = sorted({r["v"] for r in counts} | {p.modes[c]})
    return p


def assemble(df: DataFrame, names: list[str], out: str = "features") -> DataFrame:
    """P-9: pack the named columns into one MLlib vector column."""
    return VectorAssembler(inputCols=names, outputCol=out, handleInvalid="keep").transform(df)
