"""SimHash components against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

import corpus_pipeline
from cadence.llm import simhash

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("fp", T.StringType()), T.StructField("root", T.StringType())])


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    n = len(fps)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    return [find(i) for i in range(n)]


def corpus():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(2, 6)))
    base = [[word() for _ in range(300)] for _ in range(4)]
    out = []
    for k in range(60):
        w = list(base[k % 4])
        for _ in range(r.randint(0, 3)):
            w[r.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [None, "", "  \n", "one", "One", "a b c", "a b c d", "x y z w v", out[0], out[0].upper(), "q" * 5000]
    rows = [(i * 7 % 83, t) for i, t in enumerate(out)]
    return rows + [rows[0], (rows[1][0], out[9]), (None, out[2]), (None, "nothing else is like this text at all")]


@pytest.mark.parametrize("limit", [16_384, 3])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "MEET_LIMIT", limit)
    rows = corpus()
    fps = [brute_fp(t) for _, t in rows]
    roots = brute_components(fps)
    low = {}
    for (d, _), c in zip(rows, roots, strict=True):
        if d is not None:
            low[c] = min(low.get(c, d), d)
    want = sorted(((str(d), f"{f:016x}", str(low.get(c))) for (d, _), f, c in zip(rows, fps, roots, strict=True)))
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in simhash.digest(frame).collect())
    assert got == want


@pytest.mark.parametrize("share", [1, 8])
def test_hot_fingerprints_and_components(spark, monkeypatch, share):
    monkeypatch.setattr(simhash, "HOT_SHARE", share)  # no key is hot, or some are
    rows = corpus()
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    want = []
    comps = brute_components([brute_fp(t) for _, t in rows])
    for (d, _), c in zip(rows, comps, strict=True):
        ids = [i for (i, _), e in zip(rows, comps, strict=True) if e == c and i is not None]
        want.append((d, min(ids, default=None)))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_heavy_keys_take_the_meeting_points(spark):
    r = random.Random(9)
    centre = r.getrandbits(64)
    fps = sorted({centre ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 5))) for _ in range(60)}
                 | {r.getrandbits(64) for _ in range(20)})
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    roots = brute_components(fps)

    def classes(df):
        found = {row.node: row.root for row in df.collect()}
        group = {}
        for f in fps:
            group.setdefault(found.get(simhash.signed(f), f), set()).add(f)
        return sorted(map(sorted, group.values()))

    want = {}
    for f, c in zip(fps, roots, strict=True):
        want.setdefault(c, set()).add(f)
    assert classes(simhash.components(simhash.links(frame))) == sorted(map(sorted, want.values()))


def test_a_long_chain_settles(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "x long, y long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(301)}


def test_bit_counts():
    h = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert simhash.bit_counts(h).tolist() == [int(((h >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]


def test_stage_keeps_one_row_of_each_component(spark):
    rows = corpus()
    frame = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    kept = [r.doc_id for r in simhash.one_of_each(frame).collect()]
    comps = {r.component_id for r in simhash.near_duplicates(frame).collect() if r.component_id is not None}
    assert sorted(k for k in kept if k is not None) == sorted(comps) and kept.count(None) == 1


def test_rows_that_repeat_an_id_stay_with_their_component(spark):
    a, b, c = ("the first text is about a river and its banks", "another text tells of trains and of their stations",
               "a third one has some numbers and a list of names")
    both = [(5, a), (5, b), (5, a), (8, a), (9, b)]  # one id heads two components
    copy = [(3, b), (5, a), (5, b), (6, c), (6, None), (7, ""), (None, c)]
    for rows, want in ((both, [(5, a), (5, b)]), (copy, [(3, b), (5, a), (6, None), (6, c)])):
        for order in (rows, rows[::-1]):
            frame = spark.createDataFrame([(d, t, "x", "y") for d, t in order], SCHEMA)
            out = corpus_pipeline.simhash_near_dedup(spark, frame, "")
            assert out.columns == frame.columns
            assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted(want, key=str)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.digest(none).collect() == [] and simhash.one_of_each(none).collect() == []
