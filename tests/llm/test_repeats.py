"""Suffix-array and suffix-tree removal against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import types as T

from cadence.llm import repeats, suffix_dedup, suffix_tree_dedup

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("n_bytes", T.StringType()), T.StructField("a", T.StringType())])


def corpus(seed, hot=0):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    line = lambda n: " ".join(word() for _ in range(n))
    shared = [line(r.randint(20, 150)) for _ in range(4)]
    out = []
    for _ in range(30):
        parts = [line(r.randint(0, 60))]
        while r.random() < 0.6:
            s = r.choice(shared)
            cut = r.randint(0, len(s) // 2)
            parts += [s[cut:] if r.random() < 0.5 else s, line(r.randint(0, 30))]
        out.append(" ".join(parts))
    for _ in range(hot):
        out.append(f"{line(9)} {shared[0]} {line(12)}")
    out += [out[0], out[0], "x" * 3000, "ab cd " * 700, "", None, " \n\t", "\0" * 500, line(700)]
    rows = [(i * 3 % 101, t) for i, t in enumerate(out)]
    return rows + [rows[3], (None, out[1]), (rows[5][0], out[2])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


def brute_bytes(rows, size):
    seen = {}
    for i, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for p in range(len(b) - size + 1):
            seen.setdefault(b[p:p + size], []).append((i, p))
    cover = [bytearray(len((t or "").encode())) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                cover[i][p:p + size] = b"\1" * size
    out = []
    for (d, t), c in zip(rows, cover, strict=True):
        b = (t or "").encode()
        kept = bytes(x for x, hit in zip(b, c, strict=True) if not hit)
        out.append((d, len(b), sum(c), len(bytes(c).replace(b"\0", b" ").split()), kept))
    return out


def brute_words(rows, size):
    big = 1 << 63
    seen = {}
    for d, t in rows:
        w = tuple((t or "").encode().split())
        for p in range(len(w) - size + 1):
            k = w[p:p + size]
            seen[k] = min(seen.get(k, big), big if d is None else d)
    out = []
    for d, t in rows:
        w = tuple((t or "").encode().split())
        hit = set()
        for p in range(len(w) - size + 1):
            if seen[w[p:p + size]] < (big if d is None else d):
                hit.update(range(p, p + size))
        out.append((d, len(w), len(hit), b" ".join(x for i, x in enumerate(w) if i not in hit).decode()))
    return out


def key(x):
    return tuple((v is None, v) for v in x)


@pytest.mark.parametrize("limit", [2048, 2])
def test_suffix_array_removal(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "GROUP_LIMIT", limit)
    rows = corpus(1, hot=20)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in suffix_dedup.remove_repeats(frame(spark, rows), 136).collect()]
    assert sorted(got, key=key) == sorted(brute_bytes(rows, 136), key=key)


@pytest.mark.parametrize("limit", [2048, 2])
def test_suffix_tree_removal(spark, monkeypatch, limit):
    monkeypatch.setattr(repeats, "GROUP_LIMIT", limit)
    rows = corpus(2, hot=20)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept)
           for r in suffix_tree_dedup.remove_earlier(frame(spark, rows), 15).collect()]
    assert sorted(got, key=key) == sorted(brute_words(rows, 15), key=key)


def test_empty_tables(spark):
    none = frame(spark, [])
    assert suffix_dedup.digest(none).collect() == []
    assert suffix_tree_dedup.digest(none).collect() == []


def test_two_stage_order_is_the_suffix_order():
    r = random.Random(5)
    for text in (b"", b"a", b"aaaa", b"banana\0banana", bytes(r.choice(b"ab\0c") for _ in range(300))):
        order = suffix_dedup.two_stage_order(text, 400).tolist()
        assert order == sorted(range(len(text)), key=lambda i: text[i:])


def test_sorted_starts_are_the_plain_order():
    import numpy as np
    r = random.Random(8)
    for trial in range(120):
        text = bytes(r.choice((b"\0", b"\0a", b"ab\xff")[trial % 3]) for _ in range(r.randint(0, 200)))
        if trial % 2:
            text = text[:r.randint(1, 20)] * 12
        starts = np.array(sorted(r.sample(range(len(text)), r.randint(0, len(text)))), np.int64)
        for depth, most in ((3, 1), (8, 2), (13, 7), (400, 1), (400, 50)):
            want = sorted(starts.tolist(), key=lambda i: text[i:i + depth])
            assert suffix_dedup.sorted_starts(text, starts, depth, most).tolist() == want


def test_near_copies_are_sorted_in_little_memory():
    import tracemalloc

    import numpy as np
    r = random.Random(9)
    base = bytes(r.choice(b"abcdefgh ") for _ in range(1000))
    text = b"\xff".join(base[:i % 1000] + b"#%d" % i + base[i % 1000:] for i in range(700)) + b"\xff"
    tracemalloc.start()
    try:
        order = suffix_dedup.two_stage_order(text, 400)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.array_equal(np.sort(order), np.arange(len(text)))
    assert peak < 110 * len(text)  # copies of every compared suffix took 262 bytes a byte of text, now 42


def test_common_prefixes_are_lengths():
    import numpy as np
    r = random.Random(7)
    for depth in (8, 13, 300):
        segments = [bytes(r.choice(b"aab") for _ in range(n)) + b"a" * m + b"\0c\x80" for n in (3, 40, 90) for m in (0, 7, 320)]
        segments += segments[4:6]
        text = b"\xff".join(segments) + b"\xff"
        room = np.concatenate([np.arange(len(s), -1, -1) for s in segments])
        order = suffix_dedup.two_stage_order(text, depth)
        want = []
        for i, j in zip(order[:-1].tolist(), order[1:].tolist(), strict=True):
            n = 0
            while min(room[i], room[j]) >= depth and n < depth and text[i + n] == text[j + n]:
                n += 1
            want.append(n)
        assert suffix_dedup.common_prefixes(text, order, room, depth).tolist() == want
        assert depth in want and any(0 < n < depth for n in want)


def test_prefix_groups_hold_all_suffixes_that_meet():
    import numpy as np
    r = random.Random(6)
    words = np.array([r.choice([1, 1, 1, 2]) for _ in range(400)])
    pos = np.arange(380)
    together = set()
    for depth, own in suffix_tree_dedup.prefix_groups(words, pos, 20, 8):
        assert depth == 20 or len(own) <= 8
        at, node = suffix_tree_dedup.deep_nodes(words, own, depth, 20)
        for n in set(node.tolist()):
            leaves = sorted(at[node == n].tolist())
            together |= {(x, y) for x in leaves for y in leaves if x < y}
    want = {(x, y) for x in pos.tolist() for y in pos.tolist() if x < y and (words[x:x + 20] == words[y:y + 20]).all()}
    assert together == want


def test_digest_of_the_contract(spark):
    long = "héllo wörld " * 40
    r = suffix_dedup.digest(frame(spark, [(1, long), (2, "z" + long), (3, None)])).orderBy("doc_id").collect()
    assert [x.n_bytes for x in r] == [560, 561, 0] and r[0].n_removed == 560
    assert r[2].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_string_ids(spark):
    same = "x" * 300
    df = spark.createDataFrame([("b", same), ("a", same), (None, "y")], "doc_id string, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeats(df, 200).collect()}
    assert got == {"a": 300, "b": 300, None: 0}
    with pytest.raises(TypeError, match="integer doc_id"):
        suffix_tree_dedup.remove_earlier(df, 20)
