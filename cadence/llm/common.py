"""Helpers shared by the operators: stored tables, row keys, labelled samples."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the session's shared checkpoint folder and
    read it back: the lineage ends there and lost executors cost a re-read."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_bytes() -> Column:
    """The text as UTF-8 bytes; a null text is an empty one."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def keyed(docs: DataFrame) -> DataFrame:
    """``(doc_id, th, body)``. Rows are told apart by ``doc_id`` and a hash of
    the text, so repeated ids with different texts stay apart, and rows that
    repeat both get the same result."""
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                       text_bytes().alias("body"))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the keys of :func:`keyed`; null ids equal each other."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["th"] == b["th"])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def held_out() -> Column:
    """crc32 of the id as text, remainder 1 by three (a null id is not held out)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int,
                  train_only: bool = True) -> DataFrame:
    """At most ``limit`` labelled rows ``(body, y)`` for fitting, the smallest by
    a hash of the id, so the choice does not depend on the order of files. Rows
    without id, label or text, and labels of other documents, do not take part
    nor count; of several labels of one id the largest counts, of several texts
    the smallest."""
    pick = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy("doc_id").agg(F.max(label).alias("y")))
    if train_only:
        pick = pick.where(~held_out())
    pick = pick.join(docs.where("text is not null").select("doc_id"), "doc_id", "left_semi")
    pick = pick.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(pick), "doc_id")
            .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
            .select(text_bytes().alias("body"), "y"))


def columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    """Columns of an Arrow batch as Python lists."""
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
