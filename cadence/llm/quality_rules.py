"""Quality rules: a learned decision list over statistics of whole texts.

The list is found by sequential covering: a rule for low quality grows by the
threshold test with the best information gain on two thirds of the labelled
rows, is pruned on the rest, and the rows it covers leave; covering ends when
a new rule is not precise enough. What results is an ordered list of readable
conjunctions, emitted as one Spark conditional expression.

Fitting uses at most ``limit`` labelled rows (statistics only, a few numbers a
row), the smallest by a hash of the id; of several labels of one id the largest
counts. Results: one row per input row; a null, empty or blank text has no words,
so a base rule fails it. Long texts are read whole, in time linear in their
words. Repeated rows get equal results; of tests with the same gain the first by
feature and cut is taken. Without usable labels the list is empty and only the
base rules decide; an empty table of documents gives no rows. Only ``doc_id,
text`` and the labels' ``doc_id, quality`` are read, so other columns of any name
do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns, labelled_rows, text_bytes

SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 20_000
_UPPER = bytes(range(65, 91))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_bangs",
           "n_same_words")


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    size = len(number)
    pairs, at = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)
    _, at, count = np.unique(at * size + ids[2:], return_inverse=True, return_counts=True)
    edge = np.zeros(n + 1, np.int64)
    hit = np.flatnonzero(count[at] > 1)
    edge[hit] += 1
    edge[hit + 3] -= 1
    return int((np.cumsum(edge)[:n] > 0).sum())


def text_counts(body: bytes) -> tuple[int, ...]:
    words = body.split()
    lines = [x for x in body.split(b"\n") if x.strip()]
    return (len(words), sum(len(w.decode()) for w in words) if not body.isascii() else sum(map(len, words)),
            len(body) - len(body.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words),
            len(lines), len(body) - len(body.translate(None, _UPPER)), body.count(b"!"),
            sum(map(bytes.__eq__, words, words[1:])))


def statistics(docs: DataFrame, *extra: str) -> DataFrame:
    """The counts of each text; ``docs`` has ``body`` and the columns ``extra``."""
    types = dict(docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_counts(b) for b in columns(batch, "body")[0]], np.int64).reshape(-1, len(_COUNTS))
            keep = [batch.column(batch.schema.get_field_index(c)) for c in extra]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(c) for c in found.T.copy())], names=[*extra, *_COUNTS])

    schema = ", ".join([*(f"`{c}` {types[c]}" for c in extra), *(f"{c} long" for c in _COUNTS)])
    return docs.select(*extra, "body").mapInArrow(run, schema)


def features() -> dict[str, Column]:
    """What rules test: sizes and shares, zero where there is nothing to share."""
    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return {"words": F.col("n_words").cast("double"), "mean_word": share("word_chars", "n_words"),
            "symbols": share("n_symbols", "word_chars"), "dup_lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words"), "upper": share("n_upper", "word_chars"),
            "bangs": share("n_bangs", "n_words"), "same_words": share("n_same_words", "n_words")}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def mask(self, data: dict[str, np.ndarray]) -> np.ndarray:
        v = data[self.feature]
        return v >= self.threshold if self.above else v < self.threshold

    def column(self) -> Column:
        c = features()[self.feature]
        return c >= self.threshold if self.above else c < self.threshold


Rule = tuple[Test, ...]


def _covered(rule: Rule, data: dict[str, np.ndarray], n: int) -> np.ndarray:
    m = np.ones(n, bool)
    for t in rule:
        m &= t.mask(data)
    return m


def _grow(data: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule: Rule = ()
    live = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = int((live & bad).sum()), int((live & ~bad).sum())
        if not n0 or not p0:
            break
        best = (1e-9, None)
        base = np.log2(p0 / (p0 + n0))
        for name in sorted(data):
            v = np.unique(data[name][live])
            if len(v) < 2:
                continue
            at = np.unique(np.linspace(0, len(v) - 2, min(64, len(v) - 1)).round().astype(int))
            for cut in ((v[at] + v[at + 1]) / 2).tolist():
                for above in (True, False):
                    m = live & Test(name, above, cut).mask(data)
                    p = int((m & bad).sum())
                    if p:
                        gain = p * (np.log2(p / int(m.sum())) - base)
                        if gain > best[0]:
                            best = (gain, Test(name, above, cut))
        if best[1] is None:
            break
        rule += (best[1],)
        live &= best[1].mask(data)
    return rule


def learn(data: dict[str, np.ndarray], bad: np.ndarray, precision: float = 0.8, most_rules: int = 16,
          most_tests: int = 4) -> list[Rule]:
    """The ordered rules for ``bad`` rows, whatever order the rows come in."""
    order = np.lexsort([bad, *(data[k] for k in sorted(data))])
    data, bad = {k: v[order] for k, v in data.items()}, bad[order]
    rules: list[Rule] = []
    left = np.arange(len(bad))
    while len(rules) < most_rules and bad[left].sum() >= 4:
        grow, prune = left[left % 3 != 0], left[left % 3 == 0]
        rule = _grow({k: v[grow] for k, v in data.items()}, bad[grow], most_tests)
        held = {k: v[prune] for k, v in data.items()}

        def worth(r: Rule) -> float:
            m = _covered(r, held, len(prune))
            p = int((m & bad[prune]).sum())
            return (2 * p - int(m.sum())) / max(1, int(m.sum())) if m.any() else -1.0

        while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
            rule = rule[:-1]
        if not rule:
            break
        hit = _covered(rule, {k: v[left] for k, v in data.items()}, len(left))
        good = worth(rule) >= 2 * precision - 1 and bad[left][hit].mean() >= precision
        if not good:
            break
        rules.append(rule)
        left = left[~hit]
    return rules


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules from a bounded sample of the labelled rows."""
    rows = (statistics(labelled_rows(docs, labels, "quality", limit, train_only=False), "y")
            .select("y", *(c.alias(k) for k, c in features().items())).collect())
    names = list(features())
    table = np.array([[r[k] for k in names] for r in rows], float).reshape(-1, len(names))
    return learn(dict(zip(names, table.T, strict=True)), np.array([r["y"] == 0 for r in rows], bool))


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one expression: false where a rule fires first."""
    out = F.lit(True)
    for rule in reversed(rules):
        test = F.lit(True)
        for t in rule:
            test = test & t.column()
        out = F.when(test, F.lit(False)).otherwise(out)
    return out


def describe(rules: list[Rule]) -> list[str]:
    return [" and ".join(f"{t.feature} {'>=' if t.above else '<'} {t.threshold:.6g}" for t in r) for r in rules]


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rules = fit(docs, labels)
    stats = statistics(docs.select("doc_id", text_bytes().alias("body")), "doc_id")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"))
