"""Substring dedup: remove long word sequences seen in an earlier document.

Each task indexes a block of candidate segments (:mod:`cadence.llm.repeats`)
with prefix-partitioned suffix trees: suffixes are split by their first words,
prefixes of too many suffixes grow by further words until each set is
memory-sized, and the tree below each prefix is held as its sorted leaves with
the depths of the internal nodes between them. Internal nodes of at least the
window's depth are the repeats; their leaves share the smallest document id.

Results: one row per input row. A null, empty or blank text has no words. Texts of
fewer words than the window lose nothing; long ones are cut into segments and
need no more than their own words. An empty table gives an empty one. Only
``doc_id`` and ``text`` are read, so other columns of any name do not matter. Only a strictly smaller ``doc_id`` counts, so
rows that repeat an id do not remove each other; a null id is the largest.
Words are compared by 64-bit hashes, windows by all of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, keyed, same_row
from cadence.llm.repeats import Kind, merged, repeat_ranges

WINDOW = 50
#: Leaves of one subtree; prefixes of more suffixes grow.
LEAVES = 1 << 15


def prefix_groups(words: np.ndarray, suffixes: np.ndarray, size: int, leaves: int) -> Iterator[tuple[int, np.ndarray]]:
    """Split suffixes by prefixes of growing length into sets of at most
    ``leaves``: pairs (length of the shared prefix, suffixes). Suffixes alone
    under their prefix are dropped; at full length a set may be larger."""
    pending = [(0, suffixes)]
    while pending:
        depth, own = pending.pop()
        if len(own) < 2:
            continue
        if len(own) <= leaves or depth == size:
            yield depth, own
            continue
        by = np.argsort(words[own + depth], kind="stable")
        own = own[by]
        lead = words[own + depth]
        cuts = np.flatnonzero(lead[1:] != lead[:-1]) + 1
        small: list[np.ndarray] = []
        held = 0
        for part in np.split(own, cuts):
            if len(part) > leaves:
                pending.append((depth + 1, part))
            else:  # several prefixes share a set, as a forest
                if held + len(part) > leaves:
                    pending.append((depth, np.concatenate(small)))
                    small, held = [], 0
                if len(part) > 1:
                    small.append(part)
                    held += len(part)
        if held:
            pending.append((depth, np.concatenate(small)))


def deep_nodes(words: np.ndarray, leaves: np.ndarray, depth: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The subtree over ``leaves`` as its sorted leaves; returns them with the
    number of the internal node of depth ``size`` that holds each (nodes with
    one leaf included)."""
    if depth == size:
        return leaves, np.zeros(len(leaves), np.int64)
    labels = words[leaves[:, None] + np.arange(depth, size)].astype(">u4")
    row = labels.tobytes()
    wide = labels.shape[1] * 4
    by = np.array(sorted(range(len(leaves)), key=lambda i: row[i * wide:(i + 1) * wide]))
    labels = labels[by]
    differs = labels[1:] != labels[:-1]
    inner = np.where(differs.any(axis=1), differs.argmax(axis=1) + depth, size)  # depth of the node between
    return leaves[by], np.concatenate(([0], np.cumsum(inner < size)))


def earlier_windows(block: list[tuple], size: int, leaves: int = LEAVES) -> list[tuple]:
    """Index of one block of segments: ranges of windows with the smallest id
    of a document that has the same window."""
    words = np.unique(np.frombuffer(b"".join(s[-1] for s in block), np.uint64), return_inverse=True)[1]
    words = words.astype(np.int64)
    nw = np.array([s[4] for s in block])
    own = np.array([s[2] for s in block])
    begin = np.concatenate(([0], np.cumsum(nw + size - 1)[:-1]))
    suffix = np.repeat(begin - np.concatenate(([0], np.cumsum(nw)[:-1])), nw) + np.arange(nw.sum())
    seg = np.zeros(len(words), np.int64)
    seg[suffix] = np.repeat(np.arange(len(block)), nw)
    first = np.full(len(words), -1, np.int64)
    first[suffix] = own[seg[suffix]]
    for depth, group in prefix_groups(words, suffix, size, leaves):
        at, node = deep_nodes(words, group, depth, size)
        low = np.minimum.reduceat(own[seg[at]], np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1]))))
        first[at] = low[node]
    found = []
    for i, (a, b, _, _, n, _) in enumerate(block):
        lows = first[begin[i]:begin[i] + n]
        cuts = np.concatenate(([0], np.flatnonzero(lows[1:] != lows[:-1]) + 1, [n]))
        found += [(a, b, s, e - s, int(lows[s])) for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return found


def remove_earlier(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per document: ``doc_id, kept`` (words joined by one space), ``n_words``,
    ``n_removed``."""
    if size < 12:
        raise ValueError("the window has at least 12 words")
    kind = Kind(size, (size // 8, size - 4, size), word=True)
    ranges = repeat_ranges(docs, kind, lambda block: earlier_windows(block, size), "docs")
    k = keyed(docs)
    both = k.join(ranges, same_row(k, ranges), "left").select(k["doc_id"], "body", "ranges")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, rs in zip(*columns(batch, "body", "ranges"), strict=True):
                words = body.split()
                n = len(words)
                for s, e in reversed(merged(rs or [], size)):
                    del words[s:e]
                out.append((b" ".join(words).decode(), n, n - len(words)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64()), strict=True))],
                names=["doc_id", "kept", "n_words", "n_removed"])

    return both.mapInArrow(run, f"doc_id {id_type}, kept string, n_words long, n_removed long")


def digest(docs: DataFrame) -> DataFrame:
    return remove_earlier(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
