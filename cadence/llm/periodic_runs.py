"""Periodic run detection: stretches of words that repeat with one period.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal) of at least ``max(MIN_WORDS, 3 q)`` words that no neighbouring word
extends. Runs are read off maximal pairs: two occurrences ``i < j`` of a word
string of length ``l`` whose left neighbours differ and whose right neighbours
differ. If ``q = j - i <= l / 2`` and ``l + q >= MIN_WORDS``, the stretch
``[i, j + l)`` has period ``q``, cannot be extended and is long enough, so it
is a run as it stands; and every run ``[s, e)`` is the pair ``(s, s + q)`` with
``l = e - s - q``. Pairs that are a multiple of the period apart name the same
stretch; the smallest distance of a stretch is its period.

Each task takes documents in blocks. Word suffixes are sorted by prefix
doubling, only those that still share their prefix with another of the same
document; common prefixes of neighbours come from the ranks of each doubling.
The tree of LCP intervals is walked bottom-up from the intervals of at least
``2/3 MIN_WORDS`` words (shorter ones cannot hold a run). A node keeps its
occurrences in text order, each with its class, the word to its left; merging
the smaller child into the larger one, each occurrence looks at its next
neighbour on either side and pairs with it if their classes differ and their
distance allows. Neighbours are enough: occurrences of a string at most half
its length apart are an arithmetic progression in which all but the first have
the same word to their left, so a pair that leaves out an occurrence is a
multiple of the period.

Results: one row per input row, in any order. A null, empty or blank text has no
words and no runs. Long texts are one block of their own (about 100 bytes a
word while it is worked on). Of runs with an equal exponent the first by start,
then period, is the top one. Repeated rows get equal results. An empty table
gives an empty one. Only ``doc_id`` and ``text`` are read, so other columns of
any name do not matter.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, text_bytes

MIN_WORDS = 24
#: Words that a task works on at once, whole documents.
BLOCK_WORDS = 1 << 18
#: Occurrences in one bucket of a position list.
BUCKET = 1024

Rewrite = Callable[[object, list[bytes]], list[bytes]]
Run = tuple[int, int, int]  # start, length, period


def suffix_groups(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share their first ``depth`` symbols with another one, in
    suffix order, and the common prefix of each with the one before it (0 where
    that is shorter than ``depth``)."""
    n = len(symbols)
    none = np.zeros(0, np.int64)
    if n < 2:
        return none, none
    order = np.argsort(symbols, kind="stable")
    fresh = np.concatenate(([True], symbols[order][1:] != symbols[order][:-1]))
    start = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank = np.full(n + 1, -1, np.int32)  # place of the group in suffix order; the end is smallest
    rank[order] = start
    size = np.bincount(start, minlength=n)
    shared = order[size[start] > 1]
    levels, span = [rank.copy()], 1
    deep = none if depth > 1 else shared
    while len(shared):
        nxt = rank[np.minimum(shared + span, n)]
        key = (rank[shared].astype(np.int64) << 32) | (nxt.astype(np.int64) + 1)
        by = np.argsort(key, kind="stable")
        shared, key = shared[by], key[by]
        group = key >> 32
        m = np.arange(len(shared))
        in_group = np.maximum.accumulate(np.where(np.concatenate(([True], group[1:] != group[:-1])), m, 0))
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.maximum.accumulate(np.where(fresh, m, 0))
        rank[shared] = group + first - in_group
        ends = np.concatenate((np.flatnonzero(fresh), [len(shared)]))
        alone = np.repeat(np.diff(ends) == 1, np.diff(ends))
        shared, span = shared[~alone], span * 2
        levels.append(rank.copy())
        if span <= depth:
            deep = shared
    deep = deep[np.argsort(rank[deep], kind="stable")]
    if len(deep) < 2:
        return none, none
    a, b = deep[:-1].copy(), deep[1:].copy()
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(a, n)] == levels[k][np.minimum(b, n)]
        step = same.astype(np.int64) << k
        lcp, a, b = lcp + step, a + step, b + step
    lcp[lcp < depth] = 0
    return deep, np.concatenate(([0], lcp))


class Occurrences:
    """Positions in text order, in buckets, so that adding one is cheap."""

    __slots__ = ("buckets", "lows", "size")

    def __init__(self, position: int):
        self.buckets, self.lows, self.size = [[position]], [position], 1

    def around(self, p: int) -> tuple[int | None, int | None]:
        """The nearest positions below and above ``p``, which is not held."""
        i = bisect_left(self.lows, p) - 1
        if i < 0:
            return None, self.lows[0]
        own = self.buckets[i]
        j = bisect_left(own, p)
        if j < len(own):
            return own[j - 1], own[j]
        return own[-1], self.lows[i + 1] if i + 1 < len(self.lows) else None

    def add(self, p: int) -> None:
        i = max(bisect_left(self.lows, p) - 1, 0)
        own = self.buckets[i]
        insort(own, p)
        self.lows[i] = own[0]
        if len(own) > 2 * BUCKET:
            self.buckets[i:i + 1] = [own[:BUCKET], own[BUCKET:]]
            self.lows[i:i + 1] = [own[0], own[BUCKET]]
        self.size += 1

    def __iter__(self) -> Iterator[int]:
        for b in self.buckets:
            yield from b


def maximal_pairs(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Bottom-up over the LCP intervals: pairs ``(i, j, l)`` of neighbouring
    occurrences of a string of ``l`` symbols with different words to their left
    and to their right, ``2 (j - i) <= l`` and ``l + j - i >= least``."""
    found: list[tuple[int, int, int]] = []

    def merge(x: Occurrences, y: Occurrences, depth: int) -> Occurrences:
        small, large = (x, y) if x.size < y.size else (y, x)
        for p in small:
            below, above = large.around(p)
            for i, j in ((below, p), (p, above)):
                if i is not None and j is not None and 2 * (j - i) <= depth and depth + j - i >= least and left[i] != left[j]:
                    found.append((i, j, depth))
        for p in small:
            large.add(p)
        return large

    left = left.tolist()
    stack: list[tuple[int, Occurrences]] = []
    current: Occurrences | None = None
    for p, depth in zip(order.tolist(), lcp.tolist(), strict=True):
        if current is not None:
            while stack and stack[-1][0] > depth:
                top, held = stack.pop()
                current = merge(held, current, top)
            if depth == 0:
                yield from found
                found.clear()
            elif stack and stack[-1][0] == depth:
                stack[-1] = (depth, merge(stack[-1][1], current, depth))
            else:
                stack.append((depth, current))
        current = Occurrences(p)
    while stack:
        top, held = stack.pop()
        current = merge(held, current, top)
    yield from found


def runs_of(docs: list[list[bytes]], least: int = MIN_WORDS) -> list[list[Run]]:
    """Runs of each of several documents (lists of words), by start and period."""
    sizes = np.array([len(d) for d in docs], np.int64)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    out: list[dict[tuple[int, int], int]] = [{} for _ in docs]
    if begin[-1]:
        words = pa.array([w for d in docs for w in d], pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
        owner = np.repeat(np.arange(len(docs)), sizes)
        symbols = owner * (int(words.max()) + 1) + words  # no document shares a symbol with another
        order, lcp = suffix_groups(symbols, least - least // 3)
        left = np.concatenate(([-1], symbols[:-1]))
        for i, j, depth in maximal_pairs(order, lcp, left, least):
            d = int(owner[i])
            s, e, q = i - int(begin[d]), j + depth - int(begin[d]), j - i
            out[d][s, e] = min(q, out[d].get((s, e), q))
    return [sorted(((s, e - s, q) for (s, e), q in o.items()), key=lambda r: (r[0], r[2])) for o in out]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run repeats after its first period."""
    drop = np.zeros(len(words) + 1, np.int32)
    for s, length, q in runs:
        drop[s + q] += 1
        drop[s + length] -= 1
    gone = np.cumsum(drop[:-1]) > 0 if runs else ()
    return b" ".join([w for w, g in zip(words, gone, strict=True) if not g] if runs else words)


def find_runs(docs: DataFrame, least: int = MIN_WORDS, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document ``doc_id, runs`` (start, length, period in words, by start
    and period) and ``collapsed``, the text with one period of each run, words
    joined by one space. ``rewrite(doc_id, words)`` may change the words first."""
    if least < 3:
        raise ValueError("a run has at least three words")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bodies = columns(batch, "doc_id", "body")
            at = 0
            while at < len(ids):
                held, load, start = [], 0, at
                while at < len(ids) and (not held or load + len(bodies[at]) // 4 <= BLOCK_WORDS):
                    own = bodies[at].split()
                    held.append(rewrite(ids[at], own) if rewrite else own)
                    load += len(own)
                    at += 1
                found = runs_of(held, least)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, at - start),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in f] for f in found], run_type),
                     pa.array([collapsed(w, f) for w, f in zip(held, found, strict=True)], pa.binary())],
                    names=["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", text_bytes().alias("body")).mapInArrow(
        run, f"doc_id {id_type}, runs array<struct<start:long,length:long,period:long>>, collapsed binary")


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten (by a checksum of its id) with a
    repeating tail; a null id has none."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((n - a) // p + 1))[:n - a]


def digest(docs: DataFrame) -> DataFrame:
    """Of the texts with planted tails: number of runs, the run of the largest
    exponent, and hashes of all runs and of the collapsed text."""
    found = find_runs(docs, rewrite=planted)
    # exact comparison of length / period: cross products, no quotients
    ahead = (lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"],
                                 x["length"] * y["period"] > y["length"] * x["period"])
             .when(x["start"] != y["start"], x["start"] < y["start"]).otherwise(x["period"] <= y["period"]))
    top = F.aggregate(F.col("runs"), F.element_at("runs", 1), lambda x, y: F.when(ahead(x, y), x).otherwise(y))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, top).alias("_top"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[F.col("_top")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
