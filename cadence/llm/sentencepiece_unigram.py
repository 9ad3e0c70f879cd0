"""SentencePiece encoding and decoding: unigram Viterbi over a double array.

Pieces with their log scores come from a public model file (never trained
here). The driver packs them into a double-array trie, a table whose size
depends on the vocabulary alone, and broadcasts it. A text gets the marker for
each space and one in front; since no piece holds a marker after another
character, or a line break, the best path of a text is that of its units
(spaces with the word behind them, line breaks), and each distinct unit of a
batch is solved once, all units of a batch side by side.

A character without a piece costs ten less than the lowest score and is
written as its bytes. A marker that is in the text itself is written as bytes
too, so decoding restores every text exactly. Ties go to the path whose last
piece is the longer one.

Results: one row per input row. A null or empty text has no ids; decoding
gives the empty text. Long texts are encoded whole, a unit at a time; one unbroken
unit takes memory in proportion to its length. Repeated rows get equal results. An
empty table gives an empty one. Only ``doc_id`` and ``text`` are read, so other
columns of any name do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: A marker of the text itself, as bytes that no piece has.
_OWN_MARK = b"\xff\xfe\xfd"
_UNIT = re.compile(r" *[^ \n]+| +|\n")
#: Units of more bytes are solved one by one.
_SIDE_BY_SIDE = 48
#: Characters of text whose units are solved together.
_CHUNK = 1 << 21


def double_array(pieces: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value`` of a trie: the child of state s by byte c is
    ``base[s] + c + 1``, if its check is s; value is a piece's id or -1."""
    nodes: list[dict[int, int]] = [{}]
    ids = [-1]
    for piece, number in pieces:
        at = 0
        for c in piece:
            if c not in nodes[at]:
                nodes[at][c] = len(nodes)
                nodes.append({})
                ids.append(-1)
            at = nodes[at][c]
        ids[at] = number
    size = len(nodes) * 2 + 1024
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    used = bytearray(size)
    used[0] = 1
    free = 1
    queue = [(0, 0)]
    for node, state in queue:
        value[state] = ids[node]
        codes = sorted(nodes[node])
        if not codes:
            continue
        while used[free]:
            free += 1
        slot = free
        while True:
            b = slot - codes[0] - 1
            if b + codes[-1] + 2 >= len(used):
                more = len(used)
                used += bytearray(more)
                base, check, value = (np.concatenate((a, np.full(more, f, np.int32)))
                                      for a, f in ((base, 0), (check, -1), (value, -1)))
            if b >= 0 and not any(used[b + c + 1] for c in codes):
                break
            slot = used.find(b"\0", slot + 1)
            if slot < 0:
                slot = len(used)
        base[state] = b
        for c in codes:
            used[b + c + 1] = 1
            check[b + c + 1] = state
            queue.append((nodes[node][c], b + c + 1))
    end = len(used.rstrip(b"\0")) + 260
    pad = [np.concatenate((a, np.full(260, f, np.int32)))[:end] for a, f in ((base, 0), (check, -1), (value, -1))]
    return pad[0], pad[1], pad[2]


@dataclass
class Unigram:
    """``pieces``: (text with markers, score, id); ``byte_ids``: of the 256
    byte pieces, in order."""

    pieces: list[tuple[str, float, int]]
    byte_ids: list[int]
    base: np.ndarray = field(init=False)
    check: np.ndarray = field(init=False)
    value: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        if any(MARK in p.lstrip(MARK) or "\n" in p for p, _, _ in self.pieces):
            raise ValueError("a piece holds a marker inside, or a line break")
        self.base, self.check, self.value = double_array([(p.encode(), i) for p, _, i in self.pieces])
        top = max([i for _, _, i in self.pieces] + self.byte_ids) + 1
        self.scores = np.zeros(top)
        self.table = [b""] * top
        for i, n in enumerate(self.byte_ids):
            self.table[n] = bytes([i])
        for p, s, i in self.pieces:
            self.scores[i] = s
            self.table[i] = p.replace(MARK, " ").encode()
        self.unknown = min(s for _, s, _ in self.pieces) - 10.0
        self.longest = max(len(p.encode()) for p, _, _ in self.pieces)
        self.to_byte = np.array(self.byte_ids, np.int32)
        self.steps = np.ones(256, np.int64)  # bytes of a character by its first
        self.steps[0xC0:0xE0], self.steps[0xE0:0xF0], self.steps[0xF0:0xF8], self.steps[0xFF] = 2, 3, 4, 3

    @classmethod
    def load(cls, path: str = MODEL) -> Unigram:
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        normal, by_byte = [], {}
        for i in range(m.get_piece_size()):
            if m.is_byte(i):
                by_byte[int(m.id_to_piece(i)[3:-1], 16)] = i
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                normal.append((m.id_to_piece(i), m.get_score(i), i))
        return cls(normal, [by_byte[b] for b in range(256)])

    # one unit

    def _solve_one(self, unit: bytes) -> list[int]:
        n = len(unit)
        best, back, ids = [float("-inf")] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        base, check, value, scores = self.base, self.check, self.value, self.scores
        for i in range(n):
            here = best[i]
            if here == float("-inf"):
                continue
            one = min(int(self.steps[unit[i]]), n - i)
            state, single = 0, False
            for j in range(i, min(n, i + self.longest)):
                t = int(base[state]) + unit[j] + 1
                if check[t] != state:
                    break
                state = t
                v = int(value[t])
                if v >= 0:
                    single |= j + 1 - i == one
                    s = here + scores[v]
                    if s > best[j + 1]:
                        best[j + 1], back[j + 1], ids[j + 1] = s, i, v
            if not single and here + self.unknown > best[i + one]:
                best[i + one], back[i + one], ids[i + one] = here + self.unknown, i, -1
        out: list[int] = []
        while n:
            i = back[n]
            if ids[n] >= 0:
                out.append(ids[n])
            else:
                raw = unit[i:n]
                out += [self.byte_ids[b] for b in reversed(MARK.encode() if raw == _OWN_MARK else raw)]
            n = i
        return out[::-1]

    # many units, none longer than _SIDE_BY_SIDE

    def _solve_many(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after another, and where each unit's start."""
        n = len(units)
        lens = np.fromiter(map(len, units), np.int64, n)
        order = np.argsort(-lens, kind="stable")  # longest first: the live rows are a prefix
        lens = lens[order]
        wide = int(lens[0]) if n else 0
        text = np.zeros((n, wide + self.longest + 4), np.uint8)
        flat = np.frombuffer(b"".join(units[i] for i in order.tolist()), np.uint8)
        text[:, :wide][np.arange(wide) < lens[:, None]] = flat
        best = np.full((n, wide + 5), -np.inf)
        back, ids = np.zeros((n, wide + 5), np.int16), np.zeros((n, wide + 5), np.int32)
        best[:, 0] = 0.0
        for i in range(wide):
            live = int(np.searchsorted(-lens, -i, "left"))  # units longer than i
            rows = np.flatnonzero(best[:live, i] > -np.inf)
            if not len(rows):
                continue
            here = best[rows, i]
            one = np.minimum(self.steps[text[rows, i]], lens[rows] - i)
            single = np.zeros(len(rows), bool)
            walk, state = np.arange(len(rows)), np.zeros(len(rows), np.int64)
            for j in range(i, min(wide, i + self.longest)):
                r = rows[walk]
                t = self.base[state] + text[r, j].astype(np.int64) + 1
                ok = (self.check[t] == state) & (j < lens[r])
                walk, state = walk[ok], t[ok]
                if not len(walk):
                    break
                v = self.value[state]
                end = v >= 0
                if end.any():
                    w, v = walk[end], v[end]
                    single[w] |= one[w] == j + 1 - i
                    s = here[w] + self.scores[v]
                    r = rows[w]
                    up = s > best[r, j + 1]
                    r = r[up]
                    best[r, j + 1], back[r, j + 1], ids[r, j + 1] = s[up], i, v[up]
            w = np.flatnonzero(~single)
            if len(w):
                r, to, s = rows[w], i + one[w], here[w] + self.unknown
                up = s > best[r, to]
                r, to = r[up], to[up]
                best[r, to], back[r, to], ids[r, to] = s[up], i, -1
        # back along the paths; bytes of unknown characters are single steps
        rows, pos = np.arange(n), lens.copy()
        got_row, got_pos, got_id = [], [], []
        while len(rows):
            start, number = back[rows, pos].astype(np.int64), ids[rows, pos]
            known = number >= 0
            got_row.append(rows[known])
            got_pos.append(start[known])
            got_id.append(number[known])
            if not known.all():
                r, s, e = rows[~known], start[~known], pos[~known]
                for k in range(4):
                    on = s + k < e
                    byte = text[r[on], s[on] + k]
                    mark = text[r[on], s[on]] == 0xFF
                    byte = np.where(mark, np.frombuffer(MARK.encode() + b"\0", np.uint8)[k], byte)
                    got_row.append(r[on])
                    got_pos.append(s[on] + k)
                    got_id.append(self.to_byte[byte])
            rows, pos = rows[start > 0], start[start > 0]
        row, at = np.concatenate(got_row), np.concatenate(got_pos)
        number = np.concatenate(got_id).astype(np.int32)
        unit = order[row]
        by = np.argsort(unit * (wide + 8) + at, kind="stable")
        count = np.bincount(unit, minlength=n)
        return number[by], np.concatenate(([0], np.cumsum(count)))

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        units: dict[str, int] = {}
        docs = []
        for t in texts:
            found = _UNIT.findall(" " + t) if t else []
            docs.append(np.fromiter((units.setdefault(u, len(units)) for u in found), np.int64, len(found)))
        coded = []
        for u in units:
            b = u.encode()
            if MARK in u:
                b = b.replace(MARK.encode(), _OWN_MARK)
            coded.append(b.replace(b" ", MARK.encode()))
        short = [i for i, b in enumerate(coded) if len(b) <= _SIDE_BY_SIDE]
        flat, start = self._solve_many([coded[i] for i in short]) if short else (np.zeros(0, np.int32), np.zeros(1, int))
        begin, size = np.zeros(len(coded), np.int64), np.zeros(len(coded), np.int64)
        begin[short], size[short] = start[:-1], np.diff(start)
        extra, at = [flat], len(flat)
        for i, b in enumerate(coded):
            if len(b) > _SIDE_BY_SIDE:
                one = np.array(self._solve_one(b), np.int32)
                extra.append(one)
                begin[i], size[i] = at, len(one)
                at += len(one)
        flat = np.concatenate(extra)
        out = []
        for d in docs:
            n = size[d]
            where = np.repeat(begin[d] - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(d) else np.zeros(0, int)
            out.append(flat[where + np.arange(len(where))])
        return out

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.table.__getitem__, ids))
        return raw[1:].decode() if raw[:1] == b" " else raw.decode()


def encode(docs: DataFrame, model: Unigram | None = None, path: str = MODEL) -> DataFrame:
    """``(doc_id, ids, n_tokens, exact)``; ``exact``: decoding the ids gave the
    text back."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model or Unigram.load(path))  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts = [t or "" for t in columns(batch, "text")[0]]
            lo = 0
            while lo < len(texts):
                hi, load = lo, 0
                while hi < len(texts) and (hi == lo or load + len(texts[hi]) <= _CHUNK):
                    load += len(texts[hi])
                    hi += 1
                ids = m.encode_all(texts[lo:hi])
                ends = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                flat = pa.array(np.concatenate(ids))
                same = [m.decode(x.tolist()) == t for x, t in zip(ids, texts[lo:hi], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat),
                     pa.array(np.diff(ends)), pa.array(same)], names=["doc_id", "ids", "n_tokens", "exact"])
                lo = hi

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, ids array<int>, n_tokens long, exact boolean")


def decode(coded: DataFrame, model: Unigram | None = None, path: str = MODEL) -> DataFrame:
    """``coded`` with ``text`` from its ``ids`` (null ids: null)."""
    shared = coded.sparkSession.sparkContext.broadcast(model or Unigram.load(path))

    @F.pandas_udf("string")
    def back(ids):
        m = shared.value
        return ids.map(lambda x: None if x is None else m.decode([int(i) for i in x]))

    return coded.withColumn("text", back("ids"))
