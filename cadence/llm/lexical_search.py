"""Ranked lexical search: the best documents of every query item, found by
scanning the texts; there is no index of the documents.

The terms of all items form one Aho-Corasick automaton. Every term is guarded
by a blank on both sides, and a text is scanned with its non-term characters
turned into blanks, so only whole terms match; what the automaton puts out is
the term's number, which lists the items that hold it. One scan counts the
documents of each term and the lengths; a second one counts the terms again,
scores the items a document touches and keeps the best ``top`` of each item
within the task, so what is shuffled is ``top`` rows an item and task, and
neither counts nor documents are stored.

The automaton is broadcast, so its size is bounded: items are dealt to blocks
of about ``BLOCK_BYTES`` of distinct terms by a hash of their id, and each block
is scanned for by itself (one block for any usual benchmark). A term longer
than ``LONG_TERM`` bytes enters by its first ``LONG_TERM`` bytes and is then
compared in the text.

Scores are those of the query's contract: integer weights
``floor(1000 ln((2N+2)/(2df+1)))`` and integer saturation by document length.

Results: at most ``top`` rows an item, ``item_id, rank, doc_id, score``, best
first; equal scores by ascending ``doc_id``, a null id last, then by a hash of
the text. A null or empty text, or one without terms, is never returned and
counts nowhere; an item without terms has no rows. Long texts are scanned
whole. Each repeated document row is a document of its own; rows that repeat an
``item_id`` are one item with all their terms. Empty tables give no rows. Only
``doc_id, text`` and ``item_id, text`` are read, so other columns of any name
do not matter.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import columns, keyed

TOP = 10
#: Bytes of distinct item terms in one broadcast automaton, about.
BLOCK_BYTES = 8 << 20
#: Longer terms (bytes) enter the automaton by a prefix.
LONG_TERM = 256

#: Bytes that part terms become blanks, A-Z become a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
              for c in range(256))


def terms(body: bytes) -> list[bytes]:
    """The terms of a text in order, with repeats."""
    return body.translate(_FOLD).split()


class Scanner:
    """Guarded automaton over ``vocabulary``; counts its terms in texts."""

    def __init__(self, vocabulary: list[bytes]):
        self.auto = ahocorasick.Automaton()
        self.long: dict[bytes, list[tuple[int, bytes]]] = {}
        for i, t in enumerate(vocabulary):
            if len(t) > LONG_TERM:
                self.long.setdefault(t[:LONG_TERM], []).append((i, t))
            else:
                self.auto.add_word(f" {t.decode('latin-1')} ", i)
        for j, head in enumerate(self.long):
            self.auto.add_word(" " + head.decode("latin-1"), -1 - j)
        self.tails = list(self.long.values())
        if len(self.auto):
            self.auto.make_automaton()

    def count(self, body: bytes) -> tuple[int, Counter]:
        """Number of terms of the text, and how often each of the vocabulary occurs."""
        folded = b" " + body.translate(_FOLD) + b" "
        n = len(folded.split())
        if not n or not len(self.auto):
            return n, Counter()
        # one character a byte, so places in the string are places in the bytes
        found = self.auto.iter(folded.decode("latin-1"))
        if not self.tails:
            return n, Counter(i for _, i in found)
        hits: Counter = Counter()
        for end, i in found:
            if i >= 0:
                hits[i] += 1
                continue
            start = end + 1 - LONG_TERM
            for k, whole in self.tails[-1 - i]:
                if folded.startswith(whole, start) and folded[start + len(whole)] == 32:
                    hits[k] += 1
        return n, hits


_SCANNERS: dict[str, Scanner] = {}


def scanner(key: str, vocabulary: list[bytes]) -> Scanner:
    """The automaton of a broadcast vocabulary, built once a Python worker."""
    if key not in _SCANNERS:
        _SCANNERS.clear()
        _SCANNERS[key] = Scanner(vocabulary)
    return _SCANNERS[key]


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term`` (bytes), each pair once, of items that have terms."""
    id_type = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(b))) for b in columns(batch, "body")[0]]
            at = pa.array(np.repeat(np.arange(len(own)), [len(t) for t in own]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array([t for o in own for t in o], pa.binary())],
                                             names=["item_id", "term"])

    body = F.coalesce("text", F.lit("")).cast("binary").alias("body")
    return items.select("item_id", body).mapInArrow(run, f"item_id {id_type}, term binary").distinct()


def statistics(docs: DataFrame, scan: Callable[[], Scanner], size: int) -> tuple[int, int, list[int]]:
    """Documents with a term, all their terms, and documents of each of the
    ``size`` vocabulary terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = np.zeros(size, np.int64), 0, 0
        s = scan()
        for batch in batches:
            for body in columns(batch, "body")[0]:
                n, hits = s.count(body)
                n_docs += n > 0
                n_terms += n
                df[list(hits)] += 1
        keys = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((keys, [-2, -1]))), pa.array(np.concatenate((df[keys], [n_docs, n_terms])))],
            names=["k", "v"])

    sums = keyed(docs).mapInArrow(run, "k long, v long").groupBy("k").agg(F.sum("v").alias("v"))
    got = dict(map(tuple, sums.collect()))  # one row a vocabulary term of the block
    return got.get(-2, 0), got.get(-1, 0), [got.get(i, 0) for i in range(size)]


def weights(n_docs: int, df: list[int]) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]


def best_of_block(docs: DataFrame, block: DataFrame, top: int) -> DataFrame | None:
    """The best rows of the items of one block; None if it has no terms."""
    spark = docs.sparkSession
    pairs = block.groupBy("term").agg(F.collect_list(F.struct("item_id")).alias("items")).collect()
    if not pairs:
        return None
    vocabulary = [bytes(r["term"]) for r in pairs]
    ids = list(dict.fromkeys(i["item_id"] for r in pairs for i in r["items"]))
    number = {x: i for i, x in enumerate(ids)}
    lists = [[number[i["item_id"]] for i in r["items"]] for r in pairs]
    sent: Broadcast = spark.sparkContext.broadcast((uuid.uuid4().hex, vocabulary, lists))

    def scan() -> Scanner:
        return scanner(*sent.value[:2])

    n_docs, n_terms, df = statistics(docs, scan, len(vocabulary))
    w = weights(n_docs, df)
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, of_term = scan(), [np.array(x) for x in sent.value[2]]
        # item -> heap of (score, order of the row, ...): the least of the best on top
        best: dict[int, list[tuple]] = {}
        floor = np.zeros(len(ids), np.int64)  # a full heap's least score

        for batch in batches:
            for doc_id, th, body in zip(*columns(batch, "doc_id", "th", "body"), strict=True):
                n, hits = s.count(body)
                if not hits:
                    continue
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                part = [w[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)) for t, tf in hits.items()]
                own = [of_term[t] for t in hits]
                score = np.zeros(len(ids), np.int64)
                np.add.at(score, np.concatenate(own), np.repeat(np.array(part, np.int64), [len(x) for x in own]))
                for i in np.flatnonzero((score > 0) & (score >= floor)).tolist():
                    heap = best.setdefault(i, [])
                    row = (int(score[i]), _Last(doc_id, th))
                    if len(heap) < top:
                        heapq.heappush(heap, row)
                    elif row > heap[0]:
                        heapq.heapreplace(heap, row)
                    if len(heap) == top:
                        floor[i] = heap[0][0]
        rows = [(i, r[1].doc_id, r[1].th, r[0]) for i, heap in best.items() for r in heap]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), doc_type, pa.int64(), pa.int64()), strict=True)],
            names=["item", "doc_id", "th", "score"])

    doc_type = _arrow_type(docs)
    found = keyed(docs).mapInArrow(run, f"item int, doc_id {id_type}, th long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "th")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    item_type = block.schema["item_id"].dataType.simpleString()
    names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {item_type}")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


class _Last:
    """Orders rows of equal score: the later one is the lesser."""

    __slots__ = ("doc_id", "th", "key")

    def __init__(self, doc_id, th: int):
        self.doc_id, self.th, self.key = doc_id, th, (doc_id is None, doc_id if doc_id is not None else 0, th)

    def __lt__(self, other: _Last) -> bool:
        return self.key > other.key

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Last) and self.key == other.key


def _arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema["doc_id"].dataType)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each item."""
    own = item_terms(items)
    total = own.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    blocks = 1 + int(total) // block_bytes
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)) if blocks > 1 else F.lit(0)
    out = docs.sparkSession.createDataFrame(
        [], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, "
            f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    for b in range(blocks):
        part = best_of_block(docs, own.where(block == b), top)
        out = out if part is None else out.unionByName(part)
    return out
