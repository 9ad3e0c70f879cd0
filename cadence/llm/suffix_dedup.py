"""Suffix-array dedup: remove byte strings that occur again in the corpus.

Each task indexes a block of candidate segments (:mod:`cadence.llm.repeats`)
with a suffix array built by two-stage sorting: only the suffixes smaller than
their successors are sorted directly; one scan over the buckets of the first
byte induces the places of all others; the common prefixes of neighbours then
show which windows repeat.

Results: one row per input row. A null or empty text, and one shorter than the
window, has nothing removed. Long texts are cut into segments and need no more
than their own bytes. Rows that repeat another row are occurrences of their own,
so both lose their long texts; no order of rows or ids plays a part, so nothing
ties. An empty table gives an empty one. Only ``doc_id`` and ``text`` are read, so
other columns of any name do not matter. Spark shuffles hashes of segments and,
once, the texts of distinct candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, keyed, same_row
from cadence.llm.repeats import Kind, merged, repeat_ranges

WINDOW = 400
#: Suffixes that are compared by copies of their bytes at once.
COMPARED = 1 << 14


def sorted_starts(text: bytes, starts: np.ndarray, depth: int, most: int = COMPARED) -> np.ndarray:
    """``starts`` ordered by the next ``depth`` bytes; equal ones keep their order.
    Sets of more than ``most`` are split by eight bytes at a time, so the bytes of
    no more than ``most`` suffixes are copied at once, however many agree."""
    n = len(text)
    words = np.ndarray((n + 1,), ">u8", text + bytes(8), strides=(1,))
    out, pending = [], [(0, starts)]
    while pending:
        at, own = pending.pop()
        if len(own) <= most:
            out.append(np.array(sorted(own.tolist(), key=lambda i: text[i:i + depth]), np.int64))
            continue
        if at >= depth:  # equal but for zeros beyond the end: the shorter is smaller
            out.append(own[np.argsort(np.minimum(n - own, depth), kind="stable")])
            continue
        lead = words[np.minimum(own + at, n)].astype(np.uint64)
        if depth - at < 8:
            lead >>= np.uint64(64 - 8 * (depth - at))
        by = np.argsort(lead, kind="stable")
        own, lead = own[by], lead[by]
        edges = np.concatenate(([0], np.flatnonzero(lead[1:] != lead[:-1]) + 1, [len(lead)]))
        sets, s = [], 0
        while s < len(own):
            i = int(np.searchsorted(edges, s + most, "right")) - 1
            if edges[i] > s:  # several values share a set
                e, deeper = int(edges[i]), at
            else:
                e, deeper = int(edges[i + 1]), at + 8
            sets.append((deeper, own[s:e]))
            s = e
        pending += sets[::-1]
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def two_stage_order(text: bytes, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of suffixes of ``text``, ordered by their first ``depth`` bytes:
    all of them, or at least those marked in ``wanted`` (directly sorted are
    then only the suffixes that these are or are induced from)."""
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    step = np.ones(n, np.int8)  # the last suffix is larger than the empty one after it
    step[:-1] = np.sign(t[:-1].astype(np.int16) - t[1:])
    at = np.where(step != 0, np.arange(n), n - 1)
    smaller = step[np.minimum.accumulate(at[::-1])[::-1]] < 0
    seeds = np.flatnonzero(smaller)
    if wanted is not None:
        ahead = np.minimum.accumulate(np.where(smaller, np.arange(n), n)[::-1])[::-1]
        seeds = np.unique(ahead[wanted])
        seeds = seeds[seeds < n]
    direct = sorted_starts(text, seeds, depth)
    first = t[direct]
    edges = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(block: np.ndarray, c: int, ties: bool) -> None:
        prev = block[block > 0] - 1
        lead = t[prev]
        keep = lead >= c if ties else lead > c
        prev, lead = prev[keep], lead[keep]
        by = np.argsort(lead, kind="stable")
        prev, lead = prev[by], lead[by]
        cuts = np.concatenate(([0], np.flatnonzero(lead[1:] != lead[:-1]) + 1, [len(lead)]))
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if hi > lo:
                induced[lead[lo]].append(prev[lo:hi])

    order = []
    if n:
        induced[t[-1]].append(np.array([n - 1]))
    for c in range(256):
        for block in induced[c]:  # grows while it is scanned
            order.append(block)
            induce(block, c, ties=True)
        own = direct[edges[c]:edges[c + 1]]
        if len(own):
            order.append(own)
            induce(own, c, ties=False)
    return np.concatenate(order) if order else np.zeros(0, np.int64)


def common_prefixes(text: bytes, order: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """For neighbours in ``order``: how many of their first ``depth`` bytes agree,
    up to the first that differs. ``room``: bytes from each start to the end of its
    segment; starts with less than ``depth`` of them take no part (0)."""
    one, two = order[:-1], order[1:]
    shared = np.zeros(len(one), np.int64)
    pairs = np.flatnonzero((room[one] >= depth) & (room[two] >= depth))
    words = np.ndarray((len(text),), "<u8", text + bytes(8), strides=(1,))
    for step in range(0, depth, 8):  # eight bytes at a time; the last eight may look beyond the depth
        differ = words[one[pairs] + step] ^ words[two[pairs] + step]
        ends = differ != 0
        low = differ[ends]
        shared[pairs[ends]] = step + np.bitwise_count((low & -low) - np.uint64(1)).astype(np.int64) // 8
        pairs = pairs[~ends]
    shared[pairs] = depth
    return np.minimum(shared, depth)


def repeated_windows(block: list[tuple], size: int) -> list[tuple]:
    """Index of one block of segments: ranges of windows that occur again, by a
    neighbour in the suffix array or because the segment itself does."""
    text = b"\xff".join(s[-1] for s in block) + b"\xff"  # no byte of UTF-8
    lens = np.array([len(s[-1]) for s in block])
    begin = np.concatenate(([0], np.cumsum(lens + 1)[:-1]))
    room = np.repeat(begin + lens, lens + 1) - np.arange(len(text))
    order = two_stage_order(text, size, room >= size)
    agree = common_prefixes(text, order, room, size) == size
    again = np.zeros(len(text) + 1, bool)
    again[order[:-1][agree]] = True
    again[order[1:][agree]] = True
    for (_, _, _, n, nw, _), s in zip(block, begin.tolist(), strict=True):
        if n > 1:
            again[s:s + nw] = True
    edge = np.flatnonzero(np.diff(np.concatenate(([False], again)).astype(np.int8)))
    found = []
    for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        i = int(np.searchsorted(begin, s, "right")) - 1
        a, b, lo = block[i][:3]
        found.append((a, b, s - int(begin[i]), e - s, lo))
    return found


def remove_repeats(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, kept`` (the remaining bytes), ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``spans`` (removed byte ranges)."""
    if size < 136:
        raise ValueError("the window has at least 136 bytes")
    kind = Kind(size, ((size - 8) // 6 // 8 * 8, size - 16, size), word=False)
    ranges = repeat_ranges(docs, kind, lambda block: repeated_windows(block, size), "count")
    k = keyed(docs)
    both = k.join(ranges, same_row(k, ranges), "left").select(k["doc_id"], "body", "ranges")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, rs in zip(*columns(batch, "body", "ranges"), strict=True):
                spans = merged(rs or [], size)
                kept, at = [], 0
                for s, e in spans:
                    kept.append(body[at:s])
                    at = e
                kept.append(body[at:])
                out.append((b"".join(kept), len(body), sum(e - s for s, e in spans), len(spans),
                            [{"start": s, "end": e} for s, e in spans]))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(),
                     pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))],
                names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "spans"])

    return both.mapInArrow(run, f"doc_id {id_type}, kept binary, n_bytes long, n_removed long, n_spans long, "
                                "spans array<struct<start:int,end:int>>")


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                       F.sha2("kept", 256).alias("kept_sha256"))
