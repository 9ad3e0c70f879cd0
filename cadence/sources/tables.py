"""Scans (S-1, S-2) and the table profile (S-3).

``transactions`` maps any event table onto the four-column log
``(customer_id, date, type, amount)``; the window filter is written on the
source's own timestamp column so Catalyst pushes it into the Parquet scan and
only the four mapped columns are read.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import DoubleType, FloatType

from cadence.config import INCOME_CUTS, INCOME_ORDER, CustomerMapping, TxMapping


def read_table(spark: SparkSession, sf_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.{fmt}")
    if fmt == "csv":
        return read_csv_table(spark, path)
    return spark.read.parquet(path)


def source(df: DataFrame, name: str) -> Column:
    """A column of ``df``, or a SQL expression over its columns."""
    return df[f"`{name}`"] if name in df.columns else F.expr(name)


def read_csv_table(spark: SparkSession, path: str, schema: str | None = None,
                   date_format: str = "yyyy-MM-dd") -> DataFrame:
    """S-1 / S-2 for CSV inputs: header row, explicit schema when given
    (inference otherwise), dates parsed with ``date_format``."""
    r = spark.read.option("header", True).option("dateFormat", date_format)
    r = r.schema(schema) if schema else r.option("inferSchema", True)
    return r.csv(path)


def transactions(spark: SparkSession, sf_dir: str, mapping: TxMapping,
                 start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Transaction log in ``[start, end)`` (default: observation start to
    prediction end of the mapping's windows, each open if not given). Null keys
    are dropped, as a group-by on the key would drop them; keys keep their type. ``date`` is a DATE
    (trap X-2); an amount that is not a number is NULL."""
    w = mapping.windows
    start = start or w.obs_start
    end = end or w.pred_end
    src = read_table(spark, sf_dir, mapping.table, mapping.format)
    ts = F.col(mapping.date)
    kind = src.schema[mapping.date].dataType.simpleString()
    if start is not None:                         # midnight in the column's own type
        src = src.where(ts >= F.lit(start).cast(kind))
    if end is not None:
        src = src.where(ts < F.lit(end).cast(kind))
    return (
        src.where(source(src, mapping.customer_id).isNotNull() & ts.isNotNull())
        .select(
            source(src, mapping.customer_id).alias("customer_id"),
            F.to_date(ts).alias("date"),
            F.col(mapping.type).cast("string").alias("type"),
            number(F.col(mapping.amount)).alias("amount"),
        )
    )


#: Types of a log; more raise an error (each is a column of the mart).
MAX_TYPES = 500


def _observed(spark: SparkSession, sf_dir: str, mapping: TxMapping, obs_end: dt.date | None) -> DataFrame:
    w = mapping.windows
    return transactions(spark, sf_dir, mapping, w.obs_start, obs_end or w.obs_end)


def _checked(types: list[str]) -> tuple[str, ...]:
    if len(types) > MAX_TYPES:
        raise ValueError(f"the log has more than {MAX_TYPES} types; group them, or name those wanted in the mapping")
    return tuple(sorted(types))


def log_types(spark: SparkSession, sf_dir: str, mapping: TxMapping, obs_end: dt.date | None = None) -> tuple[str, ...]:
    """The mapping's declared types, else all types of the observation window
    (to ``obs_end``), sorted."""
    if mapping.types is not None:
        return tuple(mapping.types)
    rows = (_observed(spark, sf_dir, mapping, obs_end).select("type").where("type is not null").distinct()
            .limit(MAX_TYPES + 1).collect())
    return _checked([r[0] for r in rows])


def log_profile(spark: SparkSession, sf_dir: str, mapping: TxMapping,
                obs_end: dt.date | None = None) -> tuple[tuple[str, ...], int]:
    """:func:`log_types` and a bound on the observed amounts of one customer
    (the largest count of a customer and type, times the types), in one read."""
    per = _observed(spark, sf_dir, mapping, obs_end).groupBy("customer_id", "type").agg(F.count("amount").alias("n"))
    rows = per.groupBy("type").agg(F.max("n").alias("n")).limit(MAX_TYPES + 2).collect()
    found = _checked([r["type"] for r in rows if r["type"] is not None])
    return tuple(mapping.types or found), sum(r["n"] for r in rows)


def raw_transactions(spark: SparkSession, sf_dir: str, mapping: TxMapping) -> DataFrame:
    """The whole log mapped to (customer_id, date, type, amount), no window."""
    src = read_table(spark, sf_dir, mapping.table, mapping.format)
    return src.select(
        source(src, mapping.customer_id).alias("customer_id"),
        F.to_date(F.col(mapping.date)).alias("date"),
        F.col(mapping.type).cast("string").alias("type"),
        number(F.col(mapping.amount)).alias("amount"),
    )


def number(c: Column) -> Column:
    """As DOUBLE, NULL where it is not a number."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def income_bracket(balance: Column) -> Column:
    """Ordinal stand-in: fixed cuts of the account balance."""
    lo, mid, hi = INCOME_CUTS
    return (
        F.when(balance.isNull(), F.lit(None).cast("string"))
        .when(balance < lo, F.lit(INCOME_ORDER[0]))
        .when(balance < mid, F.lit(INCOME_ORDER[1]))
        .when(balance < hi, F.lit(INCOME_ORDER[2]))
        .otherwise(F.lit(INCOME_ORDER[3]))
    )


def mapped_customers(src: DataFrame, m: CustomerMapping) -> DataFrame:
    """``customer_id``, the mapping's attributes and, if it names one,
    ``sanity_score``. A number that is NaN is NULL."""
    taken = m.columns if m.columns is not None else {
        c: c for c in src.columns if c not in (m.customer_id, m.sanity)}
    out = [source(src, m.customer_id).alias("customer_id"), *(source(src, s).alias(c) for c, s in taken.items())]
    if m.sanity:
        out.append(source(src, m.sanity).cast("double").alias("sanity_score"))
    df = src.select(*out)
    return df.select(*[number(df[f"`{f.name}`"]).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
                       else df[f"`{f.name}`"] for f in df.schema.fields])


def customers(spark: SparkSession, sf_dir: str, mapping: CustomerMapping | None = None) -> DataFrame:
    """Customer snapshot of the mapping. Without one, the driver's table: key,
    numeric, ordinal and nominal attributes and a held-out sanity score
    (balance scaled to [0, 1], unrelated to activity)."""
    if mapping is not None:
        return mapped_customers(read_table(spark, sf_dir, mapping.table, mapping.format), mapping)
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        number(F.col("c_acctbal")).alias("c_acctbal"),
        F.col("c_nationkey").cast("int").alias("c_nationkey"),
        F.col("c_mktsegment"),
        income_bracket(F.col("c_acctbal")).alias("income_bracket"),
        ((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0)).alias("sanity_score"),
    )


def table_profile(df: DataFrame, date_col: str | None = None) -> DataFrame:
    """S-3: one row with row count, column count and date range."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols")]
    if date_col:
        aggs += [F.min(date_col).cast("date").alias("min_date"), F.max(date_col).cast("date").alias("max_date")]
    return df.agg(*aggs)


def source_profile(spark: SparkSession, sf_dir: str, mapping: TxMapping,
                   customer: CustomerMapping | None = None) -> DataFrame:
    """S-3 for both source tables as they are, with all their columns: one row
    per table."""
    log = read_table(spark, sf_dir, mapping.table, mapping.format)
    who = read_table(spark, sf_dir, customer.table if customer else "customer", customer.format if customer else "parquet")
    none = F.lit(None).cast("date")
    return (table_profile(log, mapping.date).select(F.lit(mapping.table).alias("table_name"), "*")
            .unionByName(table_profile(who).select(F.lit(customer.table if customer else "customer").alias("table_name"), "*",
                                                   none.alias("min_date"), none.alias("max_date"))))

