"""Personal data: regular expressions propose, checksums confirm, context scores.

Base kinds (email, ip, card, phone) are taken whenever their rule holds. Added
kinds need a valid checksum where they have one (IBAN: mod 97 over the length
that its country has), start from a score for the pattern, gain by context words just before the span, and are
taken at 0.5 or more; they never replace a base span. Positions are code points, the end exclusive.

Every pattern is linear in the text: matches cannot start inside a run of
their own characters, so long texts and long runs are read whole in linear time.
Results: one row per input row; a null or empty text has no spans. Spans that
start at the same place go by the order of their kinds. Repeated rows get equal
results. An empty table gives an empty one. Only ``doc_id`` and ``text`` are read;
:func:`redact` keeps other columns of any name (``n_chars`` follows the text).
"""

from __future__ import annotations

import hashlib
import re
import string
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import columns

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "secret")
_ORDER = {k: i for i, k in enumerate(BASE + ADDED)}

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}))")  # as far as one may go on
_ALNUM = frozenset(string.ascii_letters + string.digits)
#: How long an IBAN is, by country.
_IBAN_LENGTH = {c: int(n) for n, cs in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,XK 21:CH,HR,LI,LV "
    "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:PT,ST "
    "26:IS,TR 27:FR,GR,IT,MC,MR,SM 28:AL,AZ,CY,DO,GT,HU,LB,PL,SV 29:BR,PS,QA,UA 30:JO,KW,MU 31:MT,SC 32:LC").split())
    for c in cs.split(",")}
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_SECRET = re.compile(r"[A-Za-z0-9+/_]{16,}+={0,2}")
_ISH = re.compile(r"[0-9@]")
_CONTEXT = {"iban": re.compile(r"\b(iban|account|konto|cuenta|compte|bank)\b", re.I),
            "ssn": re.compile(r"\b(ssn|social|security|number|nummer)\b", re.I),
            "secret": re.compile(r"(password|passwd|pwd|token|secret|api.?key|access.?key|bearer|\bkey)\W*$", re.I)}
_NEAR = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def ibans(text: str) -> list[tuple[int, int]]:
    """Valid IBANs that do not overlap. Words and numbers behind one space look
    like more of it, so the country gives the length; for a country without a
    known one, the longest end of 15 to 34 characters that passes counts, where
    no IBAN of a known length is."""
    known, other = [], []
    for m in _IBAN.finditer(text):
        ends = [m.start() + i + 1 for i, c in enumerate(m[1]) if c != " "]
        length = _IBAN_LENGTH.get(m[1][:2])
        for n in (length,) if length else range(len(ends), 14, -1):
            if n <= len(ends) and text[ends[n - 1]:ends[n - 1] + 1] not in _ALNUM \
                    and mod97(text[m.start():ends[n - 1]].replace(" ", "")):
                (known if length else other).append((m.start(), ends[n - 1]))
                break
    out, fixed = [], _apart(known)
    starts = [s for s, _ in fixed]
    for s, e in other:
        i = bisect_right(starts, e - 1) - 1
        if i < 0 or fixed[i][1] <= s:
            out.append((s, e))
    return sorted(fixed + _apart(out))


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of sorted spans, those that start behind the last one taken."""
    out: list[tuple[int, int]] = []
    for s, e in spans:
        if not out or s >= out[-1][1]:
            out.append((s, e))
    return out


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches, found from each @: the part before it is the run
    of its characters since the last match."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        tail = _DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
            done = tail.end()
        at = text.find("@", max(at + 1, done))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = []
    if "@" in text:
        out += [("email", s, e) for s, e in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return ordered(out)


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], _ORDER[s[0]]))


def added_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Validated or contextual spans that do not touch base spans or each other."""
    proposed = []
    proposed += [(0.7, "iban", s, e) for s, e in ibans(text)]
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            proposed.append((0.3, "ssn", *m.span()))
    for m in _SECRET.finditer(text):
        if re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
            proposed.append((0.2, "secret", *m.span()))
    taken: list[list[int]] = []  # base spans, merged
    for _, s, e in base:
        if taken and s < taken[-1][1]:
            taken[-1][1] = max(e, taken[-1][1])
        else:
            taken.append([s, e])
    starts = [s for s, _ in taken]
    out, done = [], 0
    for score, kind, s, e in sorted(proposed, key=lambda p: (p[2], _ORDER[p[1]])):
        if _CONTEXT[kind].search(text[max(0, s - _NEAR):s]):
            score += 0.4
        i = bisect_right(starts, e - 1) - 1  # the last base span that starts before the end
        if score >= 0.5 and s >= done and (i < 0 or taken[i][1] <= s):
            out.append((kind, s, e))
            done = e
    return out


def spans_of(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans."""
    if not _ISH.search(text):
        return [], []
    base = base_spans(text)
    return base, ordered(base + added_spans(text, base))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str) -> str:
    """The text with every span replaced by its kind; overlapping spans become
    one, named by the first."""
    out, at = [], 0
    for kind, s, e in spans_of(text)[1]:
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts per base kind, ``base`` and ``spans`` as strings."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [spans_of(t or "") for t in columns(batch, "text")[0]]
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in BASE]
            base = [joined(b) for b, _ in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                 pa.array([joined(a) for _, a in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, " + "".join(f"n_{k} long, " for k in BASE) + "base_sha256 string, spans string")


def redact(docs: DataFrame) -> DataFrame:
    """Stage: the documents with their personal data replaced; ``n_chars``,
    if there, follows the new text. A null text stays null."""
    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: None if t is None else redacted(t))

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(docs["n_chars"].isNotNull(), F.length("text")).cast(kind))
    return out.select(*docs.columns)
