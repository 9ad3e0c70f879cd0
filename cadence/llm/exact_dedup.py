"""Exact dedup: texts that are equal byte for byte, one row of each stays.

Texts are compared after every run of ASCII whitespace has become one space.
Rows are grouped by a 128-bit hash of that text *and* the text itself, so the
bytes are compared inside each hash group and a collision makes two groups.
Equal texts are combined on the map side: a text that a third of all rows share
crosses the shuffle once per task. The rows then find their group by the hash.
Groups that hold more than one row in ``HOT_SHARE`` (so at most ``HOT_SHARE`` of
them) are broadcast, and their rows stay where they are; the others are joined
by a shuffle of ids and hashes. Rows of a hash that stands for several texts
(a collision; normally there is none) are joined by the text.

Results: one row per input row. A null text counts as empty; empty texts are
equal to each other. Long texts need no more than their own bytes. The smallest
``doc_id`` stays; a null id is larger than any. Of rows that repeat id and
text, one stays. An empty table gives an empty one. Only ``doc_id`` and
``text`` are read, so other columns of any name do not matter;
:func:`one_of_each` returns the columns of its input, with the values of a row
that has the smallest id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import stored

#: A group of more than one row in so many is broadcast, so at most this many groups are.
HOT_SHARE = 4096


def normalised(text: Column) -> Column:
    """The text with every run of ASCII whitespace as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits of the text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def membership(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``."""
    base = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    base = base.select("doc_id", "norm", hashed(F.col("norm")).alias("h"))
    members = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    groups = stored(base.groupBy("h", "norm").agg(*members).select("h", "keep_id", "group_size"), "exact")
    several = groups.groupBy("h").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("h")
    collided = not several.isEmpty()

    rows = base.groupBy("doc_id", "h", F.sha2("norm", 256).alias("text_sha256")).agg(F.count(F.lit(1)).alias("copies"))
    if collided:
        one_text, own = rows.join(several, "h", "left_anti"), groups.join(several, "h", "left_anti")
    else:
        one_text, own = rows, groups
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * HOT_SHARE > F.lit(total)
    hot = own.where(is_hot).select("h", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    marked = one_text.join(F.broadcast(hot), "h", "left")
    out = (marked.where("hot_size is not null")
           .select("doc_id", F.col("hot_id").alias("keep_id"), F.col("hot_size").alias("group_size"), "copies", "text_sha256")
           .unionByName(marked.where("hot_size is null").join(own.where(~is_hot), "h")
                        .select("doc_id", "keep_id", "group_size", "copies", "text_sha256")))
    if collided:  # by the text: the hash does not tell these apart
        texts = base.join(several, "h", "left_semi")
        each = texts.groupBy("h", "norm").agg(*members)
        rows = texts.groupBy("doc_id", "h", "norm").agg(F.count(F.lit(1)).alias("copies"))
        out = out.unionByName(rows.join(each, ["h", "norm"]).select(
            "doc_id", "keep_id", "group_size", "copies", F.sha2("norm", 256).alias("text_sha256")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all columns of the input."""
    row = F.struct(*[docs[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    base = docs.select(docs["doc_id"].alias("i"), normalised(docs["text"]).alias("n"), row.alias("r"))
    # a null id orders after every other
    kept = base.groupBy(content_hash(F.col("n")).alias("h"), "n").agg(
        F.min_by("r", F.struct(F.col("i").isNull(), "i")).alias("r"))
    return kept.select(*[F.col(f"r.c{i}").alias(c) for i, c in enumerate(docs.columns)])
