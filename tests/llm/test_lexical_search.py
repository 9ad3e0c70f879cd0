"""Ranked lexical search against a plain Python ranking."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from cadence.llm import lexical_search

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("score", T.StringType()), T.StructField("item_id", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("doc_id", T.StringType()), T.StructField("term", T.StringType())])

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute(docs, items, top=10):
    of = [Counter(words(t)) for _, t in docs]
    n_docs, total = sum(1 for c in of if c), sum(sum(c.values()) for c in of)
    df = Counter(t for c in of for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(words(t))
    out = []
    for item, ts in wanted.items():
        rows = []
        for (d, _), c in zip(docs, of, strict=True):
            n = sum(c.values())
            if not n:
                continue
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if score > 0:
                rows.append((-score, d is None, d or 0, d))
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:top], 1)]
    return out


def corpus(seed):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdEFé1½日") for _ in range(r.randint(1, 4))) for _ in range(150)]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n", "-", " ", "_"]) for _ in range(n))
    docs = [(i * 7 % 401, text(r.randint(0, 80))) for i in range(120)]
    docs += [docs[0], docs[0], (None, docs[1][1]), (5000, None), (5001, ""), (5002, " -- \n"), (None, docs[2][1]),
             (5003, "ab " * 300_000), (5004, "x" * 1_000_000), (5005, "日" * 300 + " " + "日" * 299),
             (5006, "y" * 300 + "1 " + "y" * 300)]
    items = [(i, text(r.randint(1, 20))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "??"), (None, text(4)), (3, text(5)), (4, items[4][1]),
              (103, "x" * 1_000_000), (104, "日" * 300), (105, "日" * 299 + " absent"), (106, "y" * 300), (107, "y" * 300 + "1")]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(*d, "s", "i") for d in docs], DOCS).repartition(5),
            spark.createDataFrame([(*i, "d", "t") for i in items], ITEMS))


@pytest.mark.parametrize("block_bytes", [1 << 20, 1000 * 1000])
def test_equals_plain_ranking(spark, block_bytes):
    docs, items = corpus(3)
    got = [tuple(r) for r in lexical_search.search(*frames(spark, docs, items), block_bytes=block_bytes).collect()]
    assert Counter(got) == Counter(brute(docs, items))


def test_many_blocks_give_the_same(spark):
    docs, items = corpus(4)
    items = [(i, t) for i, t in items if t is None or len(t) < 1000]
    got = [tuple(r) for r in lexical_search.search(*frames(spark, docs, items), top=3, block_bytes=300).collect()]
    assert Counter(got) == Counter(brute(docs, items, 3))


def test_empty_tables(spark):
    docs, items = corpus(5)
    assert lexical_search.search(*frames(spark, [], items[:5])).count() == 0
    assert lexical_search.search(*frames(spark, docs[:5], [])).count() == 0
    assert lexical_search.search(*frames(spark, [], [])).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_match_whole_and_in_the_text_order():
    s = lexical_search.Scanner([b"ab", b"b", b"abc", "é".encode()])
    n, hits = s.count("Ab abc b-b aé é xab".encode())
    assert n == 7 and dict(hits) == {0: 1, 1: 2, 2: 1, 3: 1}
