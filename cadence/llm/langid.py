"""Language identification by error-correcting output codes.

Every language has a codeword; one binary classifier over byte n-grams (one to
three bytes, hashed, length-normalised) is fitted per bit. A text goes to the
codeword with the least logistic loss, each bit weighted by its training
accuracy; a small lead over the second marks it ambiguous.

Fitting uses at most ``ROWS_PER_LANGUAGE`` rows per language, and ``ROWS`` in
all, with a crc32 remainder other than 1 and a language. Results: one row per input row. ``und`` with score 0
for a null or empty text, one without a letter (Unicode L), or when there is
nothing to learn from. Long texts are read whole. Repeated rows get equal
results; of several languages of one id the smallest is learned. Languages that
tie in loss go by their order. Empty tables give no rows. Only ``doc_id, text,
lang`` are read, so other columns of any name do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import columns, held_out, text_bytes

#: Rows to fit on, of all languages and of one.
ROWS, ROWS_PER_LANGUAGE = 6000, 600
#: More languages raise an error (the codes are searched on the driver).
MAX_LANGUAGES = 500
SPACE = 4096
LETTER = regex.compile(r"\p{L}")


def vector(body: bytes) -> np.ndarray:
    """Square roots of n-gram shares, of length one."""
    b = np.frombuffer(body.lower(), np.uint8).astype(np.uint32)
    parts = [b * np.uint32(0x9E3779B1) + np.uint32(1)]
    if len(b) > 1:
        two = b[:-1] * np.uint32(257) + b[1:]
        parts.append(two * np.uint32(0x85EBCA6B) + np.uint32(2))
        if len(b) > 2:
            parts.append((two[:-1] * np.uint32(263) + b[2:]) * np.uint32(0xC2B2AE35) + np.uint32(3))
    out = np.zeros(SPACE)
    for p in parts:
        out += np.bincount(p >> np.uint32(20), minlength=SPACE)
    total = out.sum()
    return np.sqrt(out / total if total else out).astype(np.float32)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of +-1 bits per class: all splits for up to 7 classes, else the
    best-separated of some random codes."""
    if n <= 7:
        rows = [[1 if (b >> (n - 1 - c)) & 1 else -1 for b in range(1 << (n - 1), (1 << n) - 1)] for c in range(n)]
        return np.array(rows or [[1]], np.float32).reshape(n, -1) if n > 1 else np.ones((n, 1), np.float32)
    r = np.random.default_rng(seed)
    bits = int(np.ceil(15 * np.log2(n)))
    best = max((np.where(r.random((n, bits)) < 0.5, -1, 1) for _ in range(20)),
               key=lambda m: int((m[:, None] != m[None]).sum(axis=2)[~np.eye(n, dtype=bool)].min()))
    return best.astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # [indicator, bit]
    bias: np.ndarray
    trust: np.ndarray

    def decide(self, body: bytes) -> tuple[str, float, bool]:
        margins = (vector(body) @ self.weights + self.bias).astype(float)
        loss = np.logaddexp(0, -self.code * margins) @ self.trust
        order = np.argsort(loss, kind="stable")
        p = np.exp(loss[order[0]] - loss)
        share = float(p[order[0]] / p.sum())
        return self.languages[order[0]], share, bool(len(order) > 1 and share < 0.6)


def fit_model(x: np.ndarray, names: list[str], rounds: int = 150, decay: float = 1e-4) -> Model | None:
    languages = sorted(set(names))
    if not languages:
        return None
    code = codewords(len(languages))
    index = {c: i for i, c in enumerate(languages)}
    y = code[[index[c] for c in names]]
    share = np.array([names.count(c) for c in languages], float)
    weight = (len(names) / len(languages) / share)[[index[c] for c in names]][:, None].astype(np.float32)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):
        pull = -y * weight / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30))) / len(names)
        vw = 0.9 * vw - 4.0 * (x.T @ pull + decay * w)
        vb = 0.9 * vb - 4.0 * pull.sum(axis=0)
        w, b = w + vw, b + vb
    right = (np.sign(x @ w + b) == y).mean(axis=0)
    return Model(languages, code, w, b, np.clip(2 * right - 1, 0.01, None))


def fit(docs: DataFrame, rows_in_all: int = ROWS, per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    by = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = (docs.select("doc_id", "lang").where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out())
              .groupBy("doc_id").agg(F.min("lang").alias("lang")))
    # the candidates shrink before the window: a third of all rows may have one language
    total = usable.groupBy("lang").count()
    languages = total.limit(MAX_LANGUAGES + 1).count()
    if languages > MAX_LANGUAGES:
        raise ValueError(f"lang has more than {MAX_LANGUAGES} values")
    limit = max(1, min(per_language, rows_in_all // max(1, languages)))
    total = F.broadcast(total)  # one row a language
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    pick = (usable.join(total, "lang").where(share * F.col("count") < 4.0 * limit)
            .withColumn("_n", F.row_number().over(by)).where(F.col("_n") <= limit).select("doc_id", "lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs = [vector(b).astype(np.float16).tobytes() for b in columns(batch, "body")[0]]
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), batch.column(1)], names=["x", "lang"])

    rows = (docs.select("doc_id", "text").where("text is not null").join(F.broadcast(pick), "doc_id")
            .select(text_bytes().alias("body"), "lang").mapInArrow(run, "x binary, lang string").collect())
    rows = sorted(rows, key=lambda r: (r["lang"], bytes(r["x"])))
    if not rows:
        return None
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float16) for r in rows]).astype(np.float32)
    return fit_model(x, [r["lang"] for r in rows])


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, lang_pred, score, ambiguous)``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = [m.decide(t.encode()) if m and t and LETTER.search(t) else ("und", 0.0, False)
                   for t in columns(batch, "text")[0]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.float64()),
                 pa.array([o[2] for o in out], pa.bool_())], names=["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, lang_pred string, score double, ambiguous boolean")


def digest(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
