"""Exact dedup against a plain Python grouping."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm import exact_dedup

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("h", T.StringType()), T.StructField("norm", T.StringType()),
                       T.StructField("keep_id", T.StringType())])

TEXTS = ["a b", "a  b", "a\t\nb", "A b", " a b", "a b ", "", None, " ", "\n\r\x0b\x0c", "a b", "a b c",
         "é x", "é x", "word " * 200_000, "word  " * 200_000, "x" * 1_000_000, "a b"]


def rows_of(hot=0):
    rows = [(50 - i * 2, t) for i, t in enumerate(TEXTS)]
    rows += [(7, "a b"), (7, "a b"), (7, "a b"), (None, "a b"), (None, "only null"), (None, "only null"), (9, "twin"), (9, "other")]
    return rows + [(1000 + i, "common  text" if i % 2 else "common text") for i in range(hot)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", "n", "k") for i, t in rows], SCHEMA)


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    members = defaultdict(list)
    for (i, _), n in zip(rows, norm, strict=True):
        members[n].append(i)
    seen, out = set(), []
    for (i, _), n in zip(rows, norm, strict=True):
        keep = min((m for m in members[n] if m is not None), default=None)
        first = i == keep and n not in seen
        if first:
            seen.add(n)
        out.append((i, keep, len(members[n]), first, hashlib.sha256(n.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [0, 300])
def test_equals_plain_grouping(spark, hot):
    rows = rows_of(hot)
    got = [tuple(r) for r in exact_dedup.membership(frame(spark, rows)).collect()]
    assert Counter(got) == Counter(brute(rows))


def test_collisions_are_kept_apart(spark):
    """With a hash of two values every group holds several texts; only their bytes tell them apart."""
    rows = rows_of(20)
    weak = lambda c: F.length(c) % 2
    got = [tuple(r) for r in exact_dedup.membership(frame(spark, rows), weak).collect()]
    assert Counter(got) == Counter(brute(rows))


def test_one_of_each_returns_input_columns(spark):
    rows = [(i, t) for i, t in rows_of(10) if t is None or len(t) < 100]
    df = frame(spark, rows)
    out = exact_dedup.one_of_each(df)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert Counter((i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in got) == Counter(
        (i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for (i, t), b in zip(rows, brute(rows), strict=True) if b[3])
    assert {r[2:] for r in got} == {("h", "n", "k")}


def test_empty_table(spark):
    df = frame(spark, [])
    assert exact_dedup.membership(df).count() == 0
    assert exact_dedup.one_of_each(df).count() == 0


def test_string_ids(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_dedup.membership(df).collect()} == {
        ("b", "a", False), ("a", "a", True), (None, "a", False)}
