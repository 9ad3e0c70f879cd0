"""Seeded train / validation / test split (P-1 ... P-3).

The default is a hash bucket of the key: no shuffle, reproducible in any
engine, and independent of the label, hence stratified in expectation. The
``exact`` method gives exact per-class proportions: each class is cut at order
statistics of the key's hash, which are found by counting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.config import SplitSpec
from cadence.functions.ordered import order_statistics
from cadence.session import materialize


def hash_bucket(key: Column, seed: int, buckets: int = 100) -> Column:
    """First 32 bits of md5(seed ':' key) modulo ``buckets``."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10)
    return (h.cast("long") % F.lit(buckets)).cast("int")


#: Classes of an exact stratified split (each is a few literals); more raise an error.
MAX_CLASSES = 1000


def _hash32(key: str, seed: int) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10).cast("long")


def _inside(pct: int, n: int) -> int:
    """How many places ``i`` of ``n`` have ``i / n < pct / 100``."""
    k = -(-n * pct // 100)
    while k > 0 and (k - 1) / n >= pct / 100.0:
        k -= 1
    while k < n and k / n < pct / 100.0:
        k += 1
    return k


def _class_cuts(df: DataFrame, label: str, key: str, seed: int, pcts: tuple[int, ...]) -> list[Column]:
    """For each of ``pcts``, whether a row is among that share of its class in
    the order (hash, key). Each class is cut at one order statistic of the hash;
    rows that tie with it (32 bits: a few) are cut by their key. The condition
    is made of literals, so no row is sorted or moved."""
    own = materialize(df.select(F.col(label).alias("_y"), F.col(key).alias("_k"), _hash32(key, seed).alias("_h")))
    sizes = own.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(sizes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    kind = df.schema[label].dataType
    is_class = [F.col("_y").eqNullSafe(F.lit(r["_y"]).cast(kind)) for r in sizes]
    wide = own.select("_k", *[F.when(c, F.col("_h")).alias(f"c{i}") for i, c in enumerate(is_class)])
    names = [f"c{i}" for i in range(len(sizes))]
    got = order_statistics(wide, names, [p / 100.0 for p in pcts],
                           place=lambda p, n: min(_inside(round(p * 100), n), n - 1)) if sizes else {}
    cuts = {(c, p): int(got[c, p / 100.0].low) for c in names for p in pcts}
    ties = wide.agg(*[e for (c, p), h in cuts.items() for e in (
        F.count_if(F.col(c) < h).alias(f"b_{c}_{p}"), F.count_if(F.col(c) == h).alias(f"t_{c}_{p}"))]).first() if cuts else {}
    out = []
    for pct in pcts:
        taken = F.lit(False)
        for i, r in enumerate(sizes):
            c, k = f"c{i}", _inside(pct, r["n"])
            h, need = cuts[c, pct], k - ties[f"b_{c}_{pct}"]
            hashed = _hash32(key, seed)
            if k >= r["n"]:
                inside = F.lit(True)
            elif need <= 0:
                inside = hashed < h
            elif need >= ties[f"t_{c}_{pct}"]:
                inside = hashed <= h
            else:
                first_out = wide.where(F.col(c) == h).orderBy("_k").offset(need).limit(1).first()["_k"]
                inside = (hashed < h) | ((hashed == h) & (F.col(key) < F.lit(first_out)))
            taken = F.when(F.col(label).eqNullSafe(F.lit(r["_y"]).cast(kind)), inside).otherwise(taken)
        out.append(taken)
    return out


def assign_split(df: DataFrame, spec: SplitSpec = SplitSpec(), key: str = "customer_id",
                 label: str | None = None, method: str = "hash") -> DataFrame:
    """P-1: add ``split`` in {train, val, test} (60/20/20 by default)."""
    tr, va = spec.train_pct, spec.train_pct + spec.val_pct
    if method == "hash":
        b = hash_bucket(F.col(key), spec.seed)
        s = F.when(b < tr, "train").when(b < va, "val").otherwise("test")
        return df.withColumn("split", s)
    if method == "exact":
        if label is None:
            raise ValueError("exact stratification needs a label")
        in_train, in_val = _class_cuts(df, label, key, spec.seed, (tr, va))
        return df.withColumn("split", F.when(in_train, "train").when(in_val, "val").otherwise("test"))
    raise ValueError(f"unknown split method {method!r}")


def holdout_split(df: DataFrame, seed: int = 42, test_pct: int = 20,
                  key: str = "customer_id") -> DataFrame:
    """P-3: two-way split used inside the walk-forward folds (80/20)."""
    b = hash_bucket(F.col(key), seed)
    return df.withColumn("split", F.when(b < 100 - test_pct, "train").otherwise("test"))


def split_profile(df: DataFrame, label: str) -> DataFrame:
    """P-2: size and positive rate per split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"),
                                   F.avg(F.col(label).cast("double")).alias("pos_rate"))
