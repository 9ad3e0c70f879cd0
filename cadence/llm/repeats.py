"""Candidate text for long exact repeats, shared by the two repeat removers.

A *window* is ``size`` consecutive symbols (bytes or words) of one document.
Two equal windows contain the same ``gram``-symbol strings, so they agree on
the smallest hash among them: that hash is the window's *group*. Consecutive
windows of one group form a *segment* (their joint text). Hence

* equal windows always meet in one group, wherever they are;
* a group seen only once in the corpus cannot hold a repeat and is dropped
  before any text moves;
* identical segments are counted map-side, so a passage that a third of all
  documents share crosses the shuffle once per task, not once per document.

What is left, distinct segments of repeated groups, goes to the caller's own
index (suffix array, suffix tree). A group with more than ``GROUP_LIMIT``
distinct segments (one line in very many contexts) is cut again by a longer
gram, and at last by the whole window: there the windows' own symbols are the
grouping key, compared in full, so no group has to fit into a task and nothing
is dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from cadence.llm.common import columns, keyed, same_row, stored

#: Distinct segments of one group that one task indexes together.
GROUP_LIMIT = 2048
#: Windows in a segment at most (long periodic texts are cut there).
SEGMENT_WINDOWS = 1024
#: Symbols (bytes or words) indexed at once in a task.
BLOCK_SYMBOLS = 1 << 19

_MUL = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))
_SHIFT = np.uint64(29)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * _MUL[0]
    h ^= h >> _SHIFT
    h *= _MUL[1]
    h ^= h >> _SHIFT
    return h


def gram_hashes(units: np.ndarray, span: int, gram: int) -> np.ndarray:
    """Hashes of all strings of ``gram`` symbols; ``units`` are hashes of the
    strings of ``span`` symbols at each start."""
    h = _mix(units)
    while span * 2 <= gram:
        h = _mix(h[:-span] * _MUL[2] + h[span:])
        span *= 2
    if span < gram:
        h = _mix(h[:len(h) - (gram - span)] * _MUL[2] + h[gram - span:])
    return h


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[:len(h) - (width - span)], h[width - span:])
    return h


@dataclass(frozen=True)
class Kind:
    """How texts become symbols: bytes as they are, or words as 64-bit hashes
    (8 bytes a word)."""

    size: int
    grams: tuple[int, ...]
    word: bool

    @property
    def width(self) -> int:
        return 8 if self.word else 1

    def encode(self, body: bytes) -> bytes:
        if not self.word:
            return body
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words := body.split()), np.uint64,
                           len(words)).tobytes()

    def segments(self, seq: bytes, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each segment: group hash, first window, number of windows, and at
        how many places its windows have their first smallest hash (with more
        than one, as in periodic text, it may repeat within itself)."""
        n = len(seq) // self.width
        if n < self.size:
            e = np.zeros(0, np.int64)
            return e, e, e, e
        if self.word:
            units, span = np.frombuffer(seq, np.uint64), 1
        else:
            units, span = np.ndarray((n - 7,), "<u8", seq, strides=(1,)), 8
        grams = gram_hashes(units, span, gram)
        low = sliding_min(grams, self.size - gram + 1)
        starts = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
        ends = np.concatenate((starts[1:], [len(low)]))
        if (ends - starts).max() > SEGMENT_WINDOWS:
            parts = [np.arange(s, e, SEGMENT_WINDOWS) for s, e in zip(starts, ends, strict=True)]
            starts = np.concatenate(parts)
            ends = np.concatenate((starts[1:], [len(low)]))
        leaves = grams[:len(low)] == low  # the next window has lost this one's first smallest hash
        leaves[ends - 1] = False
        return low[starts].view(np.int64), starts, ends - starts, 1 + np.add.reduceat(leaves, starts, dtype=np.int64)

    def cut(self, seq: bytes, start: int, windows: int) -> bytes:
        w = self.width
        return seq[start * w:(start + windows + self.size - 1) * w]


def content_key(part: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(part)
    return (int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True))


OCC = "g long, a long, b long, doc_id {id}, th long, s0 int, nw int, np int"


def occurrences(docs: DataFrame, kind: Kind) -> DataFrame:
    """One row per segment of every text: group ``g``, content key ``(a, b)``,
    place ``(doc_id, th, s0)``, number of windows ``nw`` and of places ``np``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    gram = kind.grams[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gs, ss, ns, ps, key, src = [], [], [], [], [], []
            for i, body in enumerate(columns(batch, "body")[0]):
                seq = kind.encode(body)
                g, s, n, p = kind.segments(seq, gram)
                if len(g):
                    gs.append(g)
                    ss.append(s)
                    ns.append(n)
                    ps.append(p)
                    src.append(np.full(len(g), i))
                    key += [content_key(kind.cut(seq, x, y)) for x, y in zip(s.tolist(), n.tolist(), strict=True)]
            if not gs:
                continue
            take = pa.array(np.concatenate(src))
            ab = np.array(key, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(gs)), pa.array(ab[:, 0].copy()), pa.array(ab[:, 1].copy()),
                 batch.column(0).take(take), batch.column(1).take(take),
                 *(pa.array(np.concatenate(x).astype(np.int32)) for x in (ss, ns, ps))],
                names=["g", "a", "b", "doc_id", "th", "s0", "nw", "np"])

    return keyed(docs).mapInArrow(run, OCC.format(id=id_type))


def fetch(docs: DataFrame, reps: DataFrame, kind: Kind) -> DataFrame:
    """Texts ``seq`` of the segments ``reps``, one join with the documents."""
    per_doc = reps.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("g", "a", "b", "lo", "hi", "n", "k", "nw", "s0")).alias("want"))
    k = keyed(docs)
    both = k.join(per_doc, same_row(k, per_doc)).select("body", "want")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = columns(batch, "body")[0]
            want = batch.column(1)
            rows = want.flatten()
            ends = np.diff(want.offsets.to_numpy())
            s0, nw = rows.field("s0").to_pylist(), rows.field("nw").to_pylist()
            seqs, at = [], 0
            for body, m in zip(bodies, ends.tolist(), strict=True):
                seq = kind.encode(body)
                seqs += [kind.cut(seq, s0[i], nw[i]) for i in range(at, at + m)]
                at += m
            yield pa.RecordBatch.from_arrays(
                [rows.field(c) for c in ("g", "a", "b", "lo", "hi", "n", "k", "nw")]
                + [pa.array(seqs, pa.binary())],
                names=["g", "a", "b", "lo", "hi", "n", "k", "nw", "seq"])

    return both.mapInArrow(run, "g long, a long, b long, lo long, hi long, n long, k long, nw int, seq binary")


#: (keys of the segment, first window, windows, smallest id of the class)
FOUND = "a long, b long, o int, m int, lo long"

#: Index of a block of segments: [(a, b, lo, n, nw, seq)] -> rows of FOUND.
Index = Callable[[list[tuple]], list[tuple]]


def indexed(segments: DataFrame, index: Index, width: int) -> DataFrame:
    """Run the index over blocks of whole groups; a block ends when it holds
    ``BLOCK_SYMBOLS`` symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        load, last, key = 0, None, None

        def flush() -> pa.RecordBatch:
            found = index(block)
            cols = list(zip(*found, strict=True)) if found else [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                names=["a", "b", "o", "m", "lo"])

        for batch in batches:
            for g, *seg in zip(*columns(batch, "g", "a", "b", "lo", "n", "nw", "seq"), strict=True):
                if g != last and load > BLOCK_SYMBOLS:
                    yield flush()
                    block, load = [], 0
                last = g
                if key != (key := (seg[0], seg[1])):  # a repeated row brings its segments twice
                    block.append(tuple(seg))
                    load += len(seg[-1]) // width
        if block:
            yield flush()

    spark = segments.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (segments.select("g", "a", "b", "lo", "n", "nw", "seq").repartition(parts, "g")
            .sortWithinPartitions("g", "a", "b").mapInArrow(run, FOUND))


def recut(segments: DataFrame, kind: Kind, gram: int) -> DataFrame:
    """Cut the texts of segments again by a longer gram; ``(pa, pb, po)`` says
    where a piece lies in its parent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, lo, hi, n, seq in zip(*columns(batch, "a", "b", "lo", "hi", "n", "seq"), strict=True):
                for g, s, w, p in zip(*(x.tolist() for x in kind.segments(seq, gram)), strict=True):
                    part = kind.cut(seq, s, w)
                    out.append((g, *content_key(part), lo, hi, n, w, p, part, a, b, s))
            names = ["g", "a", "b", "lo", "hi", "n", "nw", "np", "seq", "pa", "pb", "po"]
            kinds = [pa.int64()] * 6 + [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return segments.mapInArrow(run, "g long, a long, b long, lo long, hi long, n long, nw int, "
                                    "np int, seq binary, pa long, pb long, po int")


def _groups(segments: DataFrame, wide: str, key: str = "g") -> DataFrame:
    """Groups that can hold a repeat, ``(g, lo, k)``: more than one occurrence
    (``count``) or more than one document (``docs``); ``k``: segments."""
    stats = segments.groupBy(key).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                      F.max("np").alias("np"), F.count("*").alias("k"))
    return stats.where("n > 1 or np > 1" if wide == "count" else "lo < hi").select(key, "lo", "k")


def _distinct(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("a", "b").agg(
        F.first("g").alias("g"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n"),
        F.first("nw").alias("nw"), F.first("np").alias("np"))


def resolve(texts: DataFrame, kind: Kind, index: Index, wide: str, level: int = 0) -> DataFrame:
    """Rows of FOUND for the segments ``texts``, a stored table with ``k``."""
    small = indexed(texts.where(F.col("k") <= GROUP_LIMIT), index, kind.width)
    hot = texts.where(F.col("k") > GROUP_LIMIT).dropDuplicates(["a", "b"])
    gram = kind.grams[level + 1]
    pieces = stored(recut(hot, kind, gram), "pieces")
    at = pieces.select("g", F.col("a").alias("_a"), F.col("b").alias("_b"), "pa", "pb", "po", "nw")
    if gram == kind.size:  # a piece is one window, or equal ones in a row: its symbols decide, not their hash
        own = pieces.withColumn("window", F.substring("seq", 1, kind.size * kind.width))
        lifted = (own.select("window", "pa", "pb", "po", "nw").join(_groups(own, wide, "window"), "window")
                  .select(F.col("pa").alias("a"), F.col("pb").alias("b"), F.col("po").alias("o"),
                          F.col("nw").alias("m"), "lo"))
    else:
        child = _distinct(pieces)
        kept = child.join(_groups(child, wide).select("g", "k"), "g")
        body = pieces.groupBy("a", "b").agg(F.first("seq").alias("seq"))
        found = resolve(stored(kept.join(body, ["a", "b"]), "recut"), kind, index, wide, level + 1)
        lifted = (at.join(found, (at["_a"] == found["a"]) & (at["_b"] == found["b"]))
                  .select(F.col("pa").alias("a"), F.col("pb").alias("b"),
                          (F.col("po") + F.col("o")).cast("int").alias("o"), "m", "lo"))
    return small.unionByName(lifted)


def repeat_ranges(docs: DataFrame, kind: Kind, index: Index, wide: str) -> DataFrame:
    """``(doc_id, th, ranges)``: for each text with repeats, its repeated
    windows as ``array<struct<s: first window, m: windows>>``. With ``wide``
    "count" a window repeats if it starts anywhere else; with "docs" if it
    starts in a document with a smaller id (a null id is the largest)."""
    occ = stored(occurrences(docs, kind), "occurrences")
    if wide == "docs":
        if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
            raise TypeError("removal after the smallest doc_id needs an integer doc_id")
        rank = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)).cast("long")
    else:  # the order of ids plays no part
        rank = F.lit(0).cast("long")
    segs = occ.groupBy("g", "a", "b").agg(
        F.min(rank).alias("lo"), F.max(rank).alias("hi"), F.count("*").alias("n"),
        F.first("nw").alias("nw"), F.first("np").alias("np"), F.min(F.struct("doc_id", "th", "s0")).alias("rep"))
    kept = (segs.join(_groups(segs, wide).select("g", "k"), "g")
            .select("g", "a", "b", "lo", "hi", "n", "k", "nw", "rep.*"))
    found = resolve(stored(fetch(docs, kept, kind), "segments"), kind, index, wide)
    per_seg = (found.groupBy("a", "b").agg(F.collect_list(F.struct("o", "m", "lo")).alias("r"))
               .select(F.col("a").alias("_a"), F.col("b").alias("_b"), "r"))
    hits = (occ.join(per_seg, (occ["a"] == per_seg["_a"]) & (occ["b"] == per_seg["_b"]))
            .select("doc_id", "th", "s0", F.explode("r").alias("r")))
    if wide == "docs":
        hits = hits.where(F.col("r.lo") < rank)
    return hits.groupBy("doc_id", "th").agg(
        F.sort_array(F.collect_set(F.struct((F.col("s0") + F.col("r.o")).alias("s"), F.col("r.m").alias("m"))))
        .alias("ranges"))


def merged(ranges: list[dict], size: int) -> list[tuple[int, int]]:
    """Sorted windows ranges as disjoint spans of symbols."""
    out: list[tuple[int, int]] = []
    for r in ranges:
        s, e = r["s"], r["s"] + r["m"] + size - 1
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out
