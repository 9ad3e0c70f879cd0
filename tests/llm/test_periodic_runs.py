"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import types as T

from cadence.llm import periodic_runs

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("runs", T.StringType()), T.StructField("start", T.StringType()),
                       T.StructField("_top", T.StringType())])


def brute_runs(w, least=24):
    out = {}
    for q in range(1, len(w) // 3 + 1):
        s = 0
        while s + q < len(w):
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            length = e + q - s
            if length >= max(least, 3 * q):
                out.setdefault((s, length), q)  # smaller periods come first
            s = e + 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plant(doc_id, w):
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute(rows):
    out = []
    for d, t in rows:
        w = plant(d, re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        runs = brute_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((d, len(runs), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                    hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def texts(seed):
    r = random.Random(seed)
    pick = lambda k, n: [r.choice("abcdefgh"[:k]) for _ in range(n)]
    out = []
    for _ in range(40):
        w = pick(r.randint(1, 8), r.randint(0, 40))
        while r.random() < 0.75:
            base = pick(r.randint(1, 4), r.randint(1, 12))
            part = base * r.randint(2, 9)
            w += part[:len(part) - r.randint(0, len(base))] + pick(4, r.randint(0, 6))
        out.append(r.choice([" ", "\n", "  ", "\t"]).join(w))
    line = " ".join(f"w{i}" for i in range(30))
    out += [f"{line} " * 9, "".join(f"{line} x{i} " for i in range(60)), "a " * 23, "a " * 24, "a " * 25, "a b c d e f g h " * 3,
            " ".join(["é", "ée"] * 40), "a b " * 30, "x" * 5000]
    return out


def rows_of(seed):
    t = texts(seed)
    rows = [(i * 11 % 997, x) for i, x in enumerate(t)]
    ids = [i for i in range(2000, 2600) if zlib.crc32(str(i).encode()) % 10 == 0]
    r = random.Random(seed)
    rows += [(i, " ".join(f"v{r.randint(0, 400)}" for _ in range(r.choice([0, 1, 5, 30, 90, 200])))) for i in ids]
    return rows + [rows[0], rows[0], (None, t[1]), (3001, None), (3002, ""), (3003, " \n")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "r", "s", "t") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows = rows_of(seed)
    got = [tuple(r) for r in periodic_runs.digest(frame(spark, rows).repartition(3)).collect()]
    assert Counter(got) == Counter(brute(rows))


@pytest.mark.parametrize("least", [3, 7, 24])
def test_runs_of_blocks(least):
    docs = [[x.encode() for x in t.split()] for s in range(4, 12) for t in texts(s)]
    assert periodic_runs.runs_of(docs, least) == [brute_runs(d, least) for d in docs]


def test_every_short_string():
    """All words over two letters, up to eleven of them."""
    docs = [[b"ab"[k >> i & 1:(k >> i & 1) + 1] for i in range(n)] for n in range(12) for k in range(1 << n)]
    assert periodic_runs.runs_of(docs, 3) == [brute_runs(d, 3) for d in docs]


def test_very_long_texts():
    n = 300_000
    assert periodic_runs.runs_of([[b"a"] * n]) == [[(0, n, 1)]]
    line = [b"%d" % i for i in range(500)]
    assert periodic_runs.runs_of([[b"z", *line * 600, b"z"]]) == [[(1, n, 500)]]
    apart = [w for i in range(3000) for w in (*line[:40], b"s%d" % i)]
    assert periodic_runs.runs_of([apart]) == [[]]


def test_find_runs_returns_the_text(spark):
    out = periodic_runs.find_runs(frame(spark, [(1, "p " + "a b " * 20 + "q"), (2, None)])).collect()
    got = {r.doc_id: ([tuple(x) for x in r.runs], bytes(r.collapsed)) for r in out}
    assert got == {1: ([(1, 40, 2)], b"p a b q"), 2: ([], b"")}


def test_empty_table(spark):
    assert periodic_runs.digest(frame(spark, [])).count() == 0
