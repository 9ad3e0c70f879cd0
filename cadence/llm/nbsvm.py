"""Quality classifier: naive Bayes support vectors.

A text is a set of n-gram indicators: words and word pairs, runs of five
character classes, and runs of three marks saying whether a word repeats its
predecessor or ends a three-word run seen before. Each indicator is scaled by
its log-count ratio between the classes; a linear hinge-loss model on the
scaled, length-normalised sets is fitted by dual coordinate descent.

Fitting uses at most ``limit`` rows whose crc32 remainder is not 1. The model
(one weight per indicator, a fixed size) is broadcast; scoring is one pass over
whole texts. Results: one row per input row; a null or empty text has no
indicators and gets the score of the intercept. Long texts are read whole; an
indicator counts once however often it occurs. Repeated rows get equal scores; a
score of exactly 0.5 counts as label 1. Without labels of both classes every score
is 0.5; an empty table of documents gives no rows. Only ``doc_id, text`` and the
labels' ``doc_id, quality`` are read; :func:`accepted` keeps other columns of any
name with their values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, free_name, held_out, labelled_rows, text_bytes

SAMPLE_ROWS = 8_000
WORD_SPACE = 1 << 17
CLASSES = 9
RUN = 5
SIZE = WORD_SPACE + CLASSES ** RUN + 64

_CLASS = np.full(256, 8, np.uint8)  # beyond ASCII, control
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 11, 12, 13]] = 3
_CLASS[10] = 4
_CLASS[[ord(c) for c in "!?"]] = 5
_CLASS[[ord(c) for c in "#*$%&|<>@=+~^_{}[]\\/"]] = 6
_CLASS[[ord(c) for c in ".,;:-'\"()`"]] = 7
_MUL = np.uint64(0x9E3779B97F4A7C15)


def indicators(body: bytes) -> np.ndarray:
    """Sorted distinct indicator numbers of a text."""
    words = body.split()
    if not words:
        return np.zeros(0, np.int32)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = h[:-1] * _MUL + h[1:]
    grams = np.concatenate((h, pairs)) * _MUL >> np.uint64(47)
    out = [np.unique(grams.astype(np.int32))]
    kind = _CLASS[np.frombuffer(body, np.uint8)].astype(np.int32)
    if len(kind) >= RUN:
        run = kind[:-RUN + 1].copy()
        for i in range(1, RUN):
            run *= CLASSES
            run += kind[i:len(kind) - RUN + 1 + i]
        seen = np.zeros(CLASSES ** RUN, bool)
        seen[run] = True
        out.append(np.flatnonzero(seen).astype(np.int32) + WORD_SPACE)
    if len(words) >= 3:
        mark = np.zeros(len(words), np.int32)
        mark[1:] = h[1:] == h[:-1]
        three = pairs[:-1] * _MUL + h[2:]
        _, first = np.unique(three, return_index=True)
        again = np.ones(len(three), bool)
        again[first] = False
        mark[2:] += 2 * again
        out.append(np.unique(mark[:-2] * 16 + mark[1:-1] * 4 + mark[2:]).astype(np.int32) + WORD_SPACE + CLASSES ** RUN)
    return np.concatenate(out)


def log_ratios(sets: list[np.ndarray], good: np.ndarray, alpha: float = 1.0) -> np.ndarray:
    """Log of the classes' smoothed shares of documents with each indicator."""
    count = np.full((2, SIZE), alpha)
    for s, y in zip(sets, good, strict=True):
        count[int(y), s] += 1
    share = count / (np.array([(~good).sum(), good.sum()])[:, None] + 2 * alpha)
    return np.log(share[1] / share[0])


def fit_weights(sets: list[np.ndarray], good: np.ndarray, cost: float = 1.0, rounds: int = 30,
                seed: int = 0) -> tuple[np.ndarray, float]:
    """Weight of every indicator (ratio times hinge-loss weight) and intercept."""
    if not good.any() or good.all():
        return np.zeros(SIZE), 0.0
    ratio = log_ratios(sets, good)
    values = [ratio[s] for s in sets]
    values = [(v / max(1e-9, float(np.sqrt(v @ v)))).astype(np.float32) for v in values]
    y = np.where(good, 1.0, -1.0)
    upper = cost * np.where(good, 1.0, good.sum() / max(1, (~good).sum()) / 2)
    w, bias, dual = np.zeros(SIZE), 0.0, np.zeros(len(sets))
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(sets)).tolist():
            s, v = sets[i], values[i]
            slope = y[i] * (float(w[s] @ v) + bias) - 1
            new = min(max(dual[i] - slope / (float(v @ v) + 1.0), 0.0), upper[i])
            step = (new - dual[i]) * y[i]
            if step:
                w[s] += step * v
                bias += step
                dual[i] = new
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w * ratio, bias


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """``(weights, scale, intercept)``; ``scale`` gives a text's length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [indicators(b).tobytes() for b in columns(batch, "body")[0]]
            yield pa.RecordBatch.from_arrays([pa.array(sets, pa.binary()), batch.column(1).cast(pa.int32())],
                                             names=["s", "y"])

    rows = labelled_rows(docs, labels, "quality", limit).mapInArrow(run, "s binary, y int").collect()
    rows.sort(key=lambda r: (bytes(r["s"]), r["y"]))  # whatever order they come in
    sets, good = [np.frombuffer(bytes(r["s"]), np.int32) for r in rows], np.array([r["y"] == 1 for r in rows], bool)
    del rows
    weights, bias = fit_weights(sets, good)
    ratio = log_ratios(sets, good) if len(sets) else np.zeros(SIZE)
    return weights.astype(np.float32), (ratio ** 2).astype(np.float32), bias


def score_text(body: bytes, model: tuple[np.ndarray, np.ndarray, float]) -> float:
    weights, scale, bias = model
    s = indicators(body)
    margin = bias
    if len(s):
        margin += float(weights[s].sum(dtype=np.float64)) / max(1e-9, float(np.sqrt(scale[s].sum(dtype=np.float64))))
    return float(1 / (1 + np.exp(-np.clip(2 * margin, -30, 30))))


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], out: str = "_score") -> DataFrame:
    """``docs`` with all its columns and the score as ``out``, a name that it lacks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size, whatever the corpus

    @F.pandas_udf("double")
    def scored(bodies):
        m = shared.value
        return bodies.map(lambda b: score_text(bytes(b), m)).astype(float)

    return docs.withColumn(out, scored(text_bytes()))


def digest(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    return (score(docs.select("doc_id", "text"), fit(docs, labels, limit))
            .select("doc_id", held_out().alias("held_out"), F.col("_score").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def accepted(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """Stage: the rows that the model does not reject, with their columns."""
    own = free_name(docs, "_score")
    return score(docs, fit(docs, labels, limit), own).where(F.col(own) >= 0.5).select(*[docs[f"`{c}`"] for c in docs.columns])
