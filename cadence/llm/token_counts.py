"""Edit-aware token counts.

A document is cut into leaves where the tokenizer's pre-tokens surely end: in
front of a blank, tab or line break behind another character, and where a
letter, a digit and another sign meet. Pre-tokens never cross such a cut, so
leaves are encoded on their own and a document's count is the sum at the root of
a tree over its leaves. An edit re-encodes only the leaves it touches, and
further ones while the edited text leaves no sure cut at the region's ends; then
the sums on the paths to the root are updated.

The trees are kept as a stored table (:func:`trees`: the leaves' tokens and
lengths beside the text) and edits are counted from it (:func:`recount`), for
any number of rounds. Edits empty, merge and stretch leaves, so a text is cut
where its state says, not anew, and a state that does not fit its text is
refused.

The byte-level vocabulary is a public file, given by path; the driver reads it
and broadcasts its bytes. Edits are ``(start, end, replacement)`` in code points
of the text before them, and do not overlap; they are clipped to the text.

Results: one row per input row. A null, empty or blank text is counted as it is
(none, none, its blanks). Long texts are one tree; a text without a sure cut
(one unbroken word) is one leaf. Repeated rows get equal results. An empty table
gives an empty one. Only ``doc_id`` and ``text`` (and the columns of the state)
are read, so other columns of any name do not matter.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import pii
from cadence.llm.common import columns, stored

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public vocabulary splits text before its merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LEAF = 400
#: A whitespace run starts here, or signs of two kinds meet (an apostrophe may
#: take letters behind it). Control and unassigned characters are of no kind.
_CUT = regex.compile(
    r"(?<=[^\s\p{C}])(?=[ \t\n\r])|(?<=\p{L})(?=[^\s\p{L}\p{C}])|(?<=\p{N})(?=[^\s\p{N}\p{C}])"
    r"|(?<=[^\s\p{L}\p{N}\p{C}])(?=\p{N})|(?<=[^\s\p{L}\p{N}\p{C}'])(?=\p{L})")

Edit = tuple[int, int, str]


@lru_cache(maxsize=2)
def encoder(ranks: bytes) -> Callable[[str], int]:
    """Counts the tokens of a text by the vocabulary in these bytes."""
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    enc = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return lambda text: len(enc.encode_ordinary(text)) if text else 0


def counter(path: str = RANKS) -> Callable[[str], int]:
    with open(path, "rb") as f:
        return encoder(f.read())


def shared_counter(spark: SparkSession, path: str) -> Callable[[], Callable[[str], int]]:
    """The counter for tasks, from a broadcast of the file that the driver reads."""
    with open(path, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    return lambda: encoder(sent.value)


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text in parts of about ``size`` characters that end at sure cuts."""
    out, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + size)
        end = cut.start() if cut else len(text)
        out.append(text[at:end])
        at = end
    return out


def cut(text: str, lengths: list[int]) -> list[str]:
    """The text in parts of these lengths, which must be all of it."""
    if not lengths or any(n is None or n < 0 for n in lengths) or sum(lengths) != len(text):
        raise ValueError(f"state has leaves of {sum(n or 0 for n in lengths)} characters, the text has {len(text)}")
    ends = list(accumulate(lengths))
    return [text[e - n:e] for e, n in zip(ends, lengths, strict=True)]


class CountTree:
    """Sums of characters and tokens over the leaves of one document."""

    def __init__(self, text: str, count: Callable[[str], int], size: int = LEAF,
                 known: list[int] | None = None, lengths: list[int] | None = None) -> None:
        """``known`` and ``lengths`` are the tokens and characters of the leaves;
        ``known`` alone is that of a text which has not been edited."""
        self.count = count
        self.parts = leaves(text, size) or [""] if lengths is None else cut(text, lengths)
        if known is not None and len(known) != len(self.parts):
            raise ValueError(f"state has {len(known)} token counts for {len(self.parts)} leaves")
        n = 1
        while n < len(self.parts):
            n *= 2
        self.n = n
        tokens = known if known is not None else [count(p) for p in self.parts]
        pad = [0] * (n - len(self.parts))
        self.tokens = [0] * n + tokens + pad
        self.chars = [0] * n + [len(p) for p in self.parts] + pad
        for i in range(n - 1, 0, -1):
            self._sum(i)
        self.encoded = 0  # characters encoded by edits

    def _sum(self, i: int) -> None:
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaf_tokens(self) -> list[int]:
        return self.tokens[self.n:self.n + len(self.parts)]

    def leaf_chars(self) -> list[int]:
        return self.chars[self.n:self.n + len(self.parts)]

    def _find(self, pos: int) -> tuple[int, int]:
        """The leaf with the character ``pos`` (the last one at the end), and
        the place in it."""
        i = 1
        while i < self.n:
            i *= 2
            if pos >= self.chars[i] and self.chars[i + 1]:
                pos -= self.chars[i]
                i += 1
        return i - self.n, pos

    def _set(self, leaf: int, part: str, tokens: int) -> None:
        self.parts[leaf] = part
        i = leaf + self.n
        self.tokens[i], self.chars[i] = tokens, len(part)
        while i > 1:
            i //= 2
            self._sum(i)

    def _near(self, leaf: int, step: int) -> int | None:
        """The next leaf that way that holds text."""
        leaf += step
        while 0 <= leaf < len(self.parts):
            if self.parts[leaf]:
                return leaf
            leaf += step
        return None

    def edit(self, start: int, end: int, new: str) -> None:
        size = self.chars[1]
        start, end = min(max(start, 0), size), min(max(end, start, 0), size)
        lo, a = self._find(start)
        hi, b = self._find(end)
        region = self.parts[lo][:a] + new + self.parts[hi][b:]
        first, last = lo, hi
        while (prev := self._near(first, -1)) is not None and not _sure(self.parts[prev], region):
            region, first = self.parts[prev] + region, prev
        while (nxt := self._near(last, 1)) is not None and not _sure(region, self.parts[nxt]):
            region, last = region + self.parts[nxt], nxt
            while (prev := self._near(first, -1)) is not None and not _sure(self.parts[prev], region):
                region, first = self.parts[prev] + region, prev
        for leaf in range(first + 1, last + 1):
            self._set(leaf, "", 0)
        self._set(first, region, self.count(region))
        self.encoded += len(region)

    def apply(self, edits: list[Edit]) -> None:
        """Edits in places of the text as it was: the last one goes first."""
        for e in sorted(edits, key=lambda e: (e[0], e[1]), reverse=True):
            self.edit(*e)

    def text(self) -> str:
        return "".join(self.parts)


def _sure(left: str, right: str) -> bool:
    """Whether the place between two parts of a text is a sure cut."""
    return bool(left) and bool(right) and _CUT.match(left[-1] + right[0], 1) is not None


def redactions(text: str) -> list[Edit]:
    """Edits that replace personal data by its kind (the first of overlapping spans)."""
    out, at = [], 0
    for kind, s, e in pii.spans_of(text)[1]:
        if s >= at:
            out.append((s, e, f"<{kind}>"))
            at = e
    return out


STATE = "n_tokens long, leaf_tokens array<int>, leaf_chars array<int>, text string"
EDITS = "array<struct<start:int,end:int,text:string>>"
_LIST = pa.list_(pa.int32())


def _with_id(batch: pa.RecordBatch, rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """The batch's first column and ``rows`` as columns."""
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(cols, types.values(), strict=True))],
                                      names=["doc_id", *types])


def trees(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """State to keep: ``(doc_id, n_tokens, leaf_tokens, leaf_chars, text)`` per document."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = shared_counter(docs.sparkSession, path)
    types = {"n_tokens": pa.int64(), "leaf_tokens": _LIST, "leaf_chars": _LIST, "text": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared()
        for batch in batches:
            texts = columns(batch, "text")[0]
            built = [CountTree(t or "", count) for t in texts]
            yield _with_id(batch, [(b.total, b.leaf_tokens(), b.leaf_chars(), t) for b, t in zip(built, texts, strict=True)], types)

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {STATE}")


def redaction_edits(state: DataFrame) -> DataFrame:
    """``state`` with ``edits`` that replace the personal data of its texts."""

    @F.pandas_udf(EDITS)
    def edits(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": s, "end": e, "text": x} for s, e, x in redactions(t or "")] for t in texts], dtype=object)

    return state.withColumn("edits", edits("text"))


def recount(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``docs`` has the text, its ``leaf_tokens`` and ``leaf_chars`` (from
    :func:`trees` or the last recount; without either: count anew) and ``edits
    array<struct<start:int,end:int,text:string>>``. Returns ``(doc_id, n_tokens,
    leaf_tokens, leaf_chars, text)`` after the edits, ready for the next ones,
    and ``tokens_before``, ``n_edits`` and ``encoded``, the characters that the
    edits made encode. State that does not fit the text is an error."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if "leaf_chars" not in docs.columns:  # counts alone do not say which part of the text they are of
        docs = docs.withColumn("leaf_chars", F.lit(None).cast("array<int>"))
    shared = shared_counter(docs.sparkSession, path)
    types = {"n_tokens": pa.int64(), "leaf_tokens": _LIST, "leaf_chars": _LIST, "text": pa.string(),
             "tokens_before": pa.int64(), "n_edits": pa.int64(), "encoded": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared()
        for batch in batches:
            out = []
            for text, known, lengths, edits in zip(*columns(batch, "text", "leaf_tokens", "leaf_chars", "edits"), strict=True):
                kept = {"known": known, "lengths": lengths} if known and lengths else {}
                tree = CountTree(text or "", count, **kept)
                before, edits = tree.total, edits or []
                tree.apply([(e["start"], e["end"], e["text"] or "") for e in edits])
                after = tree.text()
                out.append((tree.total, tree.leaf_tokens(), tree.leaf_chars(), None if text is None and not after else after,
                            before, len(edits), tree.encoded))
            yield _with_id(batch, out, types)

    return docs.select("doc_id", "text", "leaf_tokens", "leaf_chars", "edits").mapInArrow(
        run, f"doc_id {id_type}, {STATE}, tokens_before long, n_edits long, encoded long")


def count_redacted(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """``(doc_id, n_tokens, n_leaves, n_edits, n_tokens_after, encoded)``: the
    tokens of each whole text, and after its personal data are replaced. The trees
    of the first count are stored; the second one reads them and encodes only
    what the edits touch."""
    kept = stored(trees(docs, path), "trees")
    after = recount(redaction_edits(kept), path)
    n_leaves = F.when(F.coalesce(F.length("text"), F.lit(0)) > 0, F.size("leaf_chars")).otherwise(0).cast("long")
    return after.select("doc_id", F.col("tokens_before").alias("n_tokens"), n_leaves.alias("n_leaves"), "n_edits",
                        F.col("n_tokens").alias("n_tokens_after"), "encoded")
