"""Data quality and column selection (Q-1 ... Q-8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DecimalType, FractionalType

from cadence.config import DROP_STRINGS, LEAKAGE_EXCLUDE


def key_profile(customers: DataFrame, tx: DataFrame, key: str = "customer_id",
                approx: bool = False) -> DataFrame:
    """Q-1 / Q-2: distinct keys per table and duplicated customer keys.
    ``approx`` switches to HyperLogLog++ for very large logs."""
    distinct = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.countDistinct(c))
    c = customers.agg(F.count(F.lit(1)).alias("n_cust_rows"), distinct(key).alias("n_cust_unique"))
    t = tx.agg(distinct(key).alias("n_tx_unique"))
    return c.crossJoin(t).select(
        "n_cust_unique", "n_tx_unique",
        (F.col("n_cust_rows") - F.col("n_cust_unique")).alias("n_duplicated"))


def duplicated_keys(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Q-2 listing: keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """X-19: fail fast when the key is not unique."""
    n = duplicated_keys(df, key).limit(1).count()
    if n:
        raise ValueError(f"{key} is not unique")
    return df


def null_profile(df: DataFrame) -> DataFrame:
    """Q-3: columns with missing values (NULL, or NaN in a floating column),
    ``n_null`` and ``pct`` (1 dp), in one pass."""
    total = F.count(F.lit(1)).alias("_n")

    def missing(c: str):
        col = F.col(f"`{c}`")
        return (col.isNull() | F.isnan(col)) if isinstance(df.schema[c].dataType, FractionalType) and not isinstance(
            df.schema[c].dataType, DecimalType) else col.isNull()

    sums = [F.sum(missing(c).cast("long")).alias(c) for c in df.columns]
    one = df.agg(total, *sums)
    stacked = one.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("n_null")) for c in df.columns
    ])).alias("_s")).select("_n", "_s.column_name", "_s.n_null")
    return (stacked.where(F.col("n_null") > 0)
                   .select("column_name", "n_null",
                           F.round(F.col("n_null") * 100.0 / F.col("_n"), 1).alias("pct")))


def orphan_counts(customers: DataFrame, tx: DataFrame, key: str = "customer_id") -> DataFrame:
    """Q-4 / J-5: keys of either table missing from the other (anti joins on
    distinct keys)."""
    ck = customers.select(key).distinct()
    tk = tx.select(key).where(F.col(key).isNotNull()).distinct()
    a = ck.join(tk, key, "left_anti").agg(F.count(F.lit(1)).alias("orphans_cust_to_tx"))
    b = tk.join(ck, key, "left_anti").agg(F.count(F.lit(1)).alias("orphans_tx_to_cust"))
    return a.crossJoin(b)


def clean_customers(df: DataFrame, exclude=LEAKAGE_EXCLUDE, drop_strings=DROP_STRINGS,
                    holdout: tuple[str, ...] = ()) -> DataFrame:
    """Q-5 / Q-6 / Q-7: drop leakage and high-cardinality columns (missing
    names are ignored), drop held-out scores, cast booleans to int."""
    out = df.drop(*exclude).drop(*drop_strings).drop(*holdout)
    return out.select(*[F.col(f.name).cast("int").alias(f.name)
                        if isinstance(f.dataType, BooleanType) else F.col(f.name)
                        for f in out.schema.fields])


def sanity_holdout(df: DataFrame, score_col: str, key: str = "customer_id") -> DataFrame:
    """Q-8: keep the external score aside for the post-hoc check."""
    return df.select(key, score_col)
