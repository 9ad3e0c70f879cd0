"""Quality, language, PII, tokens, decontamination and the pipeline on small
frames: brute force, round trips and held-out accuracy, and the edge cases of
every operator (nulls, empty and long texts, repeated rows, clashing columns)."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm import (
    common,
    decontaminate,
    langid,
    nbsvm,
    pii,
    quality_rules,
    sentencepiece_unigram,
    token_counts,
)

SF = "/root/testdata/sf0.001"
CLASH = ["score", "pos", "term", "n_words", "body", "_score", "words", "th"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()),
                       *(T.StructField(c, T.StringType()) for c in CLASH)])
EDGE = [None, "", " \n\t ", "x", "a" * 5000, "Ünï cödé ▁ 日本語", "one two three " * 400, "\0\x1f"]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", *CLASH) for i, t in rows], SCHEMA)


def edge_rows():
    rows = list(enumerate(EDGE))
    return [*rows, rows[6], (None, EDGE[5]), (3, "another text with id three")]


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


# op1

def brute_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


def test_statistics_match_brute_force(spark):
    texts = [*EDGE[:4], *EDGE[5:], "a b c a b c\nx\nx\n \n \nx # | é", "p q r s p q r"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r for r in quality_rules.digest(frame(spark, rows), labels_of(spark, [])).collect()}
    for i, t in rows:
        r, want = got[i], brute_counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def test_rules_separate_and_read_like_rules(spark):
    r = np.random.default_rng(0)
    data = {"symbols": r.random(900), "words": r.integers(0, 500, 900).astype(float)}
    bad = (data["symbols"] > 0.7) & (data["words"] < 300)
    rules = quality_rules.learn(data, bad)
    hit = np.zeros(900, bool)
    for rule in rules:
        hit |= quality_rules._covered(rule, data, 900)
    assert (hit == bad).mean() > 0.95


def test_rules_do_not_depend_on_the_order_of_rows():
    r = np.random.default_rng(1)
    data = {k: r.random(300) for k in ("symbols", "words", "upper")}
    bad = (data["symbols"] + 0.3 * r.random(300) > 0.9) & (data["words"] < 0.6)
    rules = quality_rules.learn(data, bad)
    assert rules
    for _ in range(5):
        p = r.permutation(300)
        assert quality_rules.learn({k: v[p] for k, v in data.items()}, bad[p]) == rules


def test_rules_are_learned_from_the_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    assert quality_rules.fit(docs, labels)
    out = quality_rules.digest(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    low, high = ([r.kept for r in out if r.quality == q] for q in (0, 1))
    assert len(low) >= 5 and np.mean(low) <= 0.2 and np.mean(high) >= 0.9


def test_quality_rules_on_edge_rows_and_empty_tables(spark):
    out = quality_rules.digest(frame(spark, edge_rows()), labels_of(spark, [(0, 0, 0), (3, 1, 0), (None, 1, 0)])).collect()
    assert len(out) == len(edge_rows())
    assert quality_rules.digest(frame(spark, []), labels_of(spark, [])).collect() == []


# op4 and op8

def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = nbsvm.digest(docs, labels).join(labels, "doc_id").collect()
    test = [r for r in out if r.held_out]
    assert all(r.held_out == held(r.doc_id) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in out)
    assert test and np.mean([r.predicted == r.quality for r in test]) >= 0.9


def test_labels_of_other_documents_leave_the_sample_alone(spark):
    docs = frame(spark, [(i, f"text {i}") for i in range(40)] + [(i, None) for i in range(40, 400)])
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(4000)])
    for limit, want in ((10, 10), (100, 40)):
        rows = common.labelled_rows(docs, labels, "quality", limit, train_only=False).collect()
        assert len(rows) == want and all(int(bytes(r.body).split()[1]) % 2 == r.y for r in rows)
    assert common.labelled_rows(docs, labels, "quality", 100).count() == sum(not held(i) for i in range(40))


def test_classifier_edges(spark):
    rows = edge_rows()
    few = labels_of(spark, [(i, i % 2, 0) for i in range(8)])
    for labels in (few, labels_of(spark, [])):
        out = nbsvm.digest(frame(spark, rows), labels).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert nbsvm.digest(frame(spark, []), few).collect() == []
    kept = nbsvm.accepted(frame(spark, rows), few)
    assert kept.columns == frame(spark, rows).columns


def test_dual_coordinate_descent_keeps_the_box():
    sets = [np.array(s, np.int32) for s in ([0, 1], [0, 2], [3, 4], [3, 5])]
    w, b = nbsvm.fit_weights(sets, np.array([True, True, False, False]))
    assert w[[0, 1, 2]].sum() + b > 0 > w[[3, 4, 5]].sum() + b


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = langid.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    test = [r for r in out if r.held_out]
    assert test and np.mean([r.lang_pred == r.lang for r in test]) >= 0.95


def test_language_edges(spark):
    rows = edge_rows()
    out = langid.digest(frame(spark, rows)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in out if r.doc_id in (0, 1, 2, 7)} == {"und"}
    assert langid.digest(frame(spark, [])).collect() == []


def test_codewords_are_apart():
    for n in (2, 3, 4, 7, 12):
        code = langid.codewords(n)
        apart = (code[:, None] != code[None]).sum(axis=2)[~np.eye(n, dtype=bool)]
        assert apart.min() >= max(1, code.shape[1] // 4)


# op6

def brute_base(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+".replace("\\x20-", " \\-"), text):
        d = re.sub("[^0-9]", "", m[0])
        s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


def test_base_spans_match_brute_force():
    r = random.Random(4)
    parts = ["a.b@c.de", "x@y", "@", "p@q.r_s@t.u", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "+1 (632) 555-4827", "+12", "é", " ", "\n", "9", ".", "-", "+", "0049", "a@b.c@d.e.f", "00000000000000"]
    for _ in range(3000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert pii.base_spans(t) == brute_base(t), t


def test_added_spans_are_confirmed():
    text = "bank DE89 3704 0044 0532 0130 00, wrong DE89 3704 0044 0532 0130 01; SSN 123-45-6789 but 123-45-6788; " \
           "password=15959ad9338a8dac1d"
    kinds = [(k, text[s:e]) for k, s, e in pii.spans_of(text)[1] if k in pii.ADDED]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in kinds and ("secret", "15959ad9338a8dac1d") in kinds
    assert ("ssn", "123-45-6789") in kinds and not any("0130 01" in v for _, v in kinds)


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947",
                                  "FR14 2004 1010 0505 0001 3M02 606", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("before, after", [
    ("IBAN ", " BIC COBADEFF"), ("", " 20 EUR"), ("pay ", " A"), ("REF AB12 ", " 7 X 123456789 GMBH"), ("QQ12 ", ""),
    ("", " 20Eur"), ("", " DE89 3704 0044 0532 0130 01"), ("", "\n20 EUR")])
def test_iban_ends_where_its_country_says(iban, before, after):
    text = before + iban + after
    assert pii.ibans(text) == [(len(before), len(before) + len(iban))]
    assert iban not in pii.redacted(text)


def test_iban_of_any_country_and_none():
    def made(country, bban):
        return next(x for k in range(2, 99) if pii.mod97((x := f"{country}{k:02d}{bban}")))
    for bban in ("ABCD1234567", "0123456789" * 3):  # the shortest and the longest
        x = made("QX", bban)
        assert pii.ibans(f"to {x}.") == [(3, 3 + len(x))]
        assert pii.ibans(f"to {x} ...") == [(3, 3 + len(x))]
    short = made("QX", "ABCD1234567")
    assert any(s == 3 and e >= 3 + len(short) for s, e in pii.ibans(f"to {short} BIC"))
    both = "DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32 20 EUR"
    assert [both[s:e] for s, e in pii.ibans(both)] == [both[:27], both[28:55]]
    for text in ("DE89 3704 0044 0532 0130 01 BIC", "DE89 3704 0044 0532 0130 00X", "XDE89 3704 0044 0532 0130 00",
                 "DE89  3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 0"):
        assert pii.ibans(text) == [], text


def test_redacted_text_holds_no_iban(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFF"), (2, "DE89 3704 0044 0532 0130 00 20 EUR")]
    assert [r.spans for r in pii.detect(frame(spark, rows)).orderBy("doc_id").collect()] == ["iban:5:32", "iban:0:27"]
    assert [r.text for r in pii.redact(frame(spark, rows)).orderBy("doc_id").collect()] == [
        "IBAN <iban> BIC COBADEFF", "<iban> 20 EUR"]


def test_detect_and_redact(spark):
    text = "é mail a.b@c.de or +1 (632) 555-4827"
    rows = [*edge_rows(), (50, text)]
    out = {r.doc_id: r for r in pii.detect(frame(spark, rows)).collect()}
    assert (out[50].n_email, out[50].n_ip, out[50].n_card, out[50].n_phone) == (1, 0, 0, 1)
    assert out[50].base_sha256 == hashlib.sha256(b"email:7:15,phone:19:36").hexdigest()
    assert out[0].spans == "" and len(pii.detect(frame(spark, rows)).collect()) == len(rows)
    clean = pii.redact(frame(spark, rows).withColumn("n_chars", F.length("text").cast("long")))
    got = {r.doc_id: r for r in clean.collect()}
    assert got[50].text == "é mail <email> or <phone>" and got[50].n_chars == 25 and got[0].text is None
    assert pii.detect(frame(spark, [])).collect() == []


def test_long_runs_are_linear():
    t = "1" * 200_000 + "a" * 200_000 + "@" + "+" * 50_000
    pii.spans_of(t)


# op3

def tiny():
    pieces = [("▁", -3.0), ("▁a", -1.0), ("a", -2.0), ("b", -2.0), ("ab", -2.5), ("▁ab", -6.0), ("ba", -3.5), ("bb", -4.5),
              ("▁▁", -9.0), ("é", -5.0)]
    return sentencepiece_unigram.Unigram([(p, s, 300 + i) for i, (p, s) in enumerate(pieces)], list(range(256)))


def brute_score(m, text):
    """Best score over all segmentations of the marked text."""
    marked = ("▁" + text.replace(" ", "▁")) if text else ""
    score = {p: s for p, s, _ in m.pieces}
    best = [0.0] + [float("-inf")] * len(marked)
    for i in range(len(marked)):
        for j in range(i + 1, len(marked) + 1):
            s = score.get(marked[i:j], m.unknown if j == i + 1 else float("-inf"))
            best[j] = max(best[j], best[i] + s)
    return best[-1]


def path_score(m, ids):
    score, out, run = {i: s for _, s, i in m.pieces}, 0.0, b""
    for i in [*ids, None]:
        if i is not None and i < 256:
            run += bytes([i])
            continue
        out += m.unknown * len(run.decode()) if run else 0.0
        run = b""
        out += score.get(i, 0.0)
    return out


def test_viterbi_is_the_best_path():
    m, r = tiny(), random.Random(3)
    texts = ["".join(r.choice("aab bé z\n") for _ in range(r.randint(0, 14))) for _ in range(600)] + ["ab" * 60, "z" * 70]
    for t, ids in zip(texts, m.encode_all(texts), strict=True):
        assert m.decode(ids.tolist()) == t
        assert path_score(m, ids.tolist()) == pytest.approx(brute_score(m, t)), t


def test_never_worse_than_the_public_library():
    """The same pieces as a unigram model: equal paths, or a better score."""
    import duckdb
    import sentencepiece
    with open(sentencepiece_unigram.MODEL, "rb") as f:
        raw = f.read().replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01")
    lib, m = sentencepiece.SentencePieceProcessor(model_proto=raw), sentencepiece_unigram.Unigram.load()
    texts = [t.split("\n")[0][:400] for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' LIMIT 150").fetchall()]
    texts = [t for t in texts if "  " not in t and not any(lib.is_byte(i) for i in lib.encode(t))]
    assert len(texts) > 50
    for a, b in zip(m.encode_all(texts), lib.encode(texts), strict=True):
        ours, theirs = m.scores[a].sum(), m.scores[b].sum()
        assert a.tolist() == b or ours > theirs


def test_encode_and_decode_frames(spark):
    rows = edge_rows()
    coded = sentencepiece_unigram.encode(frame(spark, rows))
    assert all(r.exact for r in coded.collect())
    back = sentencepiece_unigram.decode(coded).collect()
    assert sorted(r.text for r in back) == sorted(t or "" for _, t in rows)
    assert sentencepiece_unigram.encode(frame(spark, [])).collect() == []


# op9

def test_edits_equal_a_full_recount():
    count, r = token_counts.counter(), random.Random(2)
    bits = ["word", "wörter", " ", "  ", "\n", "it's", "12", " x", ", ", "a" * 30]
    for _ in range(200):
        text = "".join(r.choice(bits) + r.choice(["", " "]) for _ in range(r.randint(0, 80)))
        tree = token_counts.CountTree(text, count, size=r.choice([1, 10, 60]))
        assert tree.total == count(text)
        edits, at = [], 0
        while r.random() < 0.8 and at <= len(text):
            s = r.randint(at, len(text))
            e = r.randint(s, min(len(text), s + 40))
            edits.append((s, e, "".join(r.choice(bits) for _ in range(r.randint(0, 3)))))
            at = e + 1
        tree.apply(edits)
        for s, e, new in reversed(edits):
            text = text[:s] + new + text[e:]
        assert tree.text() == text and tree.total == count(text) == sum(tree.leaf_tokens())


def test_sure_cuts_never_change_a_count():
    """Cut at every sure place, the parts' counts add up to that of the whole, whatever the text."""
    count, r = token_counts.counter(), random.Random(8)
    bits = [*"aZé日本ßǅ0９½²'’\"。、,.-_!#😀́\u200d\x1c\x1f\x00\x85\xa0\u3000 \t\n\r", "  ", "\n\n", " \n", "'s", "'ll", "don't",
            "it's 5", "1st", "日本語。", "\u0378"]
    for _ in range(4000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 25)))
        parts = token_counts.leaves(text, 1)
        assert "".join(parts) == text and sum(map(count, parts)) == count(text), (text, parts)
        assert all(token_counts._sure(a, b) for a, b in zip(parts, parts[1:], strict=False)), (text, parts)


def test_texts_without_blanks_have_leaves():
    """Lines of one word, and Chinese, are cut too; one unbroken word is one leaf."""
    count = token_counts.counter()
    for text in ("word\n" * 5000, "天地玄黄，宇宙洪荒。" * 1000, "a1b2" * 3000):
        tree = token_counts.CountTree(text, count)
        assert len(tree.parts) > 20 and max(map(len, tree.parts)) <= 2 * token_counts.LEAF and tree.total == count(text)
        tree.edit(5000, 5003, "x")
        assert tree.total == count(text[:5000] + "x" + text[5003:]) and tree.encoded < 2000
    assert len(token_counts.CountTree("a" * 3000, count).parts) == 1


def test_the_query_counts_from_stored_trees(spark, monkeypatch):
    """The kept table alone gives the second count: neither its text nor its state is built again."""
    docs = frame(spark, [(1, "write to a.b@c.de now " * 200), (2, "no data " * 300), (3, None), (4, ""), (5, " ")])
    names = []
    monkeypatch.setattr(token_counts, "stored", lambda df, label: names.append(df.columns) or common.stored(df, label))
    got = {x.doc_id: x for x in token_counts.count_redacted(docs).collect()}
    assert names == [["doc_id", "n_tokens", "leaf_tokens", "leaf_chars", "text"]]
    assert (got[1].n_edits, got[2].n_edits, got[2].encoded) == (200, 0, 0) and got[2].n_leaves > 1
    assert [(got[i].n_tokens, got[i].n_leaves) for i in (3, 4, 5)] == [(0, 0), (0, 0), (1, 1)]


def test_an_edit_encodes_its_region_only():
    text = "some words here " * 2000
    tree = token_counts.CountTree(text, token_counts.counter())
    tree.edit(16_000, 16_003, "other")
    assert 0 < tree.encoded < 2000


def test_count_frames(spark):
    count = token_counts.counter()
    rows = [*edge_rows(), (60, "write to a.b@c.de now " * 50)]
    docs = frame(spark, rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_tokens_after, r.n_edits) for r in token_counts.count_redacted(docs).collect())
    want = sorted((str(i), count(t or ""), count("" if not t else re.sub(r"a\.b@c\.de", "<email>", t)), (t or "").count("@"))
                  for i, t in rows)
    assert got == want
    state = token_counts.trees(docs)
    some = docs.where("doc_id = 60").join(state.select("doc_id", "leaf_tokens"), "doc_id").withColumn(
        "edits", F.array(F.struct(F.lit(0).alias("start"), F.lit(5).alias("end"), F.lit("Send").alias("text"))))
    assert token_counts.recount(some).first().n_tokens == count("Send" + rows[-1][1][5:])
    assert token_counts.count_redacted(frame(spark, [])).collect() == []


def test_kept_trees_last_for_further_rounds(spark):
    count, r = token_counts.counter(), random.Random(5)
    texts = {i: "".join(r.choice(["some ", "wörter, ", "x", "12 ", "it's ", "\n"]) for _ in range(900)) for i in range(6)}
    texts |= {6: "", 7: None, 8: "short"}
    docs = frame(spark, texts.items()).select("doc_id", "text")
    state = docs.join(token_counts.trees(docs).drop("n_tokens"), "doc_id").collect()
    schema = "doc_id long, text string, leaf_tokens array<int>, leaf_chars array<int>, " \
             "edits array<struct<start:int,end:int,text:string>>"
    for _ in range(3):
        rows = []
        for s in state:
            old, edits, at = texts[s.doc_id] or "", [], 0
            while at <= len(old):
                a = r.randint(at, min(len(old), at + 900))
                b = min(len(old), a + r.choice([0, 3, 700]))
                edits.append((a, b, r.choice(["", " new words", "y" * 500, "é"])))
                at = b + 300
            new = old
            for a, b, x in reversed(edits):
                new = new[:a] + x + new[b:]
            texts[s.doc_id] = new
            rows.append((s.doc_id, s.text, s.leaf_tokens, s.leaf_chars, edits))
        state = token_counts.recount(spark.createDataFrame(rows, schema)).collect()
        assert len(state) == len(texts)
        for s in state:
            assert (s.text or "") == texts[s.doc_id] and s.n_tokens == count(texts[s.doc_id]) == sum(s.leaf_tokens)
            assert sum(s.leaf_chars) == len(texts[s.doc_id]) and len(s.leaf_chars) == len(s.leaf_tokens)
    kept = [(s.doc_id, s.text, s.leaf_tokens, s.leaf_chars, [(0, 1, "Z")]) for s in state if s.doc_id == 0]
    again = token_counts.recount(spark.createDataFrame(kept, schema)).first()
    assert 0 < again.encoded < len(again.text) and again.n_tokens == count("Z" + kept[0][1][1:])
    assert token_counts.recount(spark.createDataFrame(kept, schema).drop("leaf_chars")).first().n_tokens == again.n_tokens


def test_state_of_another_text_is_refused():
    count, text = token_counts.counter(), "some words here " * 200
    tree = token_counts.CountTree(text, count)
    known, lengths = tree.leaf_tokens(), tree.leaf_chars()
    assert token_counts.CountTree(text, count, known=known, lengths=lengths).total == count(text)
    for bad in ({"known": known, "lengths": [*lengths[:-1], lengths[-1] + 1]}, {"known": known[1:], "lengths": lengths},
                {"known": known[1:]}, {"known": known, "lengths": []}, {"known": known, "lengths": [-1, *lengths[1:-1], 1]}):
        with pytest.raises(ValueError):
            token_counts.CountTree(text, count, **bad)


# op7

def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_contamination(rows, items, size):
    out = []
    for d, t in rows:
        w, hit, found = words_of(t), set(), set()
        for i, x in items:
            v = words_of(x)
            n = min(size, len(v))
            grams = {tuple(v[k:k + n]) for k in range(len(v) - n + 1)} if v else set()
            for p in range(len(w) - n + 1) if n else ():
                if tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
                    found |= {str(i)} if i is not None else set()
        out.append((str(d), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_contamination_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    r = random.Random(11)
    line = lambda n: " ".join(r.choice(["the", "of", "a", "Zürich", "x1", "ÉTÉ", "q", "we"]) for _ in range(n))
    items = [(i, line(r.choice([1, 3, 5, 6, 9, 12]))) for i in range(8)] + [(20, ""), (21, None), (None, line(7))]
    items += [items[2], (22, items[3][1])]
    rows = [(i, f"{line(r.randint(0, 20))}, {r.choice(items)[1] or ''} {line(r.randint(0, 9))}") for i in range(25)]
    rows += edge_rows()[:4] + [rows[0], (None, rows[1][1]), (1, "zz " + (items[4][1] or "")), (70, "zzzzzzz " * 40)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, term string")
    got = sorted((str(x.doc_id), x.n_words, x.n_hit, x.n_items, x.items_sha256, x.contaminated) for x in
                 decontaminate.contamination(frame(spark, rows), bench, 6).select(
                     "doc_id", "n_words", "n_hit", F.size("items").alias("n_items"),
                     F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated").collect())
    assert got == brute_contamination(rows, items, 6)


def brute_proximity(rows, items, size, slop):
    """``{(doc, text): item ids}`` by looking at every place of every window."""
    counts = Counter(w for _, t in rows for w in words_of(t))
    out = {}
    for d, t in rows:
        w, found = words_of(t), set()
        for i, x in items:
            v = words_of(x)
            n = min(size, len(v))
            for s in range(len(v) - n + 1) if n else ():
                rank = sorted((counts[v[k]], k) for k in range(s, s + n) if counts[v[k]])[:2]
                if not rank:
                    continue
                p1, p2 = rank[0][1], rank[-1][1] if len(rank) > 1 else None
                for p in range(len(w)):
                    if w[p] != v[p1]:
                        continue
                    second = p2 is None or any(w[q] == v[p2] and q != p and abs(q - p - (p2 - p1)) <= slop for q in range(len(w)))
                    held = sum(v[k] in w[max(0, p + k - p1 - slop):max(0, p + k - p1 + slop + 1)] for k in range(s, s + n))
                    if second and 4 * held >= 3 * n and i is not None:
                        found.add(str(i))
        out[d, t] = sorted(found)
    return out


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_proximity_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    r = random.Random(12)
    vocab = [f"w{k}" for k in range(30)] + ["the", "of", "a"] * 8
    line = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(line(r.choice([1, 2, 4, 8, 8, 15])))) for i in range(12)] + [(20, ""), (21, None), (22, "absent words only"),
                                                                                    (23, "w1 absent w2 the w3")]

    def loose(text):
        """The words with some put in, left out or moved by one place."""
        w = (text or "").split()
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(w) + 1)
            change = r.choice(["in", "out", "swap"])
            if change == "in":
                w.insert(k, r.choice(vocab))
            elif change == "out":
                del w[k:k + 1]
            else:
                w[k:k + 2] = w[k:k + 2][::-1]
        return w

    rows = [(i, " ".join(line(r.randint(0, 6)) + loose(r.choice(items)[1]) + line(r.randint(0, 6)))) for i in range(60)]
    rows += [(90, "w1 w2 the w3"), (91, "the the the"), (92, None), (93, ""), rows[0]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(spark, rows)
    want = brute_proximity(rows, items, 6, 2)
    got = sorted((x.doc_id, x.n_near_items, x.near_items_sha256) for x in decontaminate.digest(docs, bench, 6, 2).collect())
    assert got == sorted((d, len(want[d, t]), hashlib.sha256(",".join(want[d, t]).encode()).hexdigest()) for d, t in rows)
    listed = {(m.doc_id, str(m.item_id)) for m in decontaminate.Index(docs, bench, 6).proximity_matches(2).collect()}
    assert listed == {(d, i) for (d, _), ids in want.items() for i in ids}
    exact = {str(d): k for d, _, _, k, _, _ in brute_contamination(rows, items, 6)}
    assert sum(map(len, want.values())) > sum(exact.values()) > 0


def test_decontamination_of_empty_tables_and_proximity(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.digest(frame(spark, []), bench).collect() == []
    docs = frame(spark, [(1, "alpha x beta y gamma z"), (2, "gamma"), (3, "alpha beta gamma"), (4, None)])
    assert [r.n_hit for r in decontaminate.digest(docs, none).collect()] == [0] * 4
    near = decontaminate.Index(docs, bench).proximity_matches(2).collect()
    assert {r.doc_id for r in near} == {1, 3} and {abs(r.shift) for r in near if r.doc_id == 3} == {0}
    assert sorted(r.doc_id for r in decontaminate.clean(docs, bench).collect()) == [1, 2, 4]


def test_decontamination_with_an_unbroken_word_and_a_long_text(spark, monkeypatch):
    """A word of 2 MB in an item, and a text of a million characters, by broadcast and by shuffle."""
    huge = "q" * 2_000_000
    bench = spark.createDataFrame([(1, f"alpha {huge} beta"), (2, "z zz zzz end of it"), (3, huge)], "item_id long, text string")
    long_text = "the word " * 110_000
    rows = [(1, f"x alpha {huge} beta y"), (2, long_text + "z zz zzz end of it"), (3, f"{huge}x"), (4, "z zz zzz"), (1, f"x alpha {huge} beta y")]
    want = sorted([(1, 5, 3, 2), (2, 220_006, 6, 1), (3, 1, 0, 0), (4, 3, 0, 0), (1, 5, 3, 2)])
    for limit in (200_000, 0):
        monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
        got = decontaminate.digest(frame(spark, rows), bench).collect()
        assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in got) == want
    assert decontaminate.free_word(spark.createDataFrame([("z",), ("zzz",), ("a",)], "term string")) == "zz"


def test_decontamination_shuffles_narrow_rows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    rows = spark.createDataFrame([(1, 2, 3, "w")], "doc_id long, th long, pos int, term string")
    terms = spark.createDataFrame([("w", 1)], "term string, seed int")
    joined = decontaminate.by_term(rows, terms)
    assert set(joined.columns) == {"doc_id", "th", "pos", "term", "seed"}
    assert [tuple(r) for r in joined.select("doc_id", "pos", "term", "seed").collect()] == [(1, 3, "w", 1)]


def test_clashing_columns_keep_their_values(spark):
    from cadence.llm import nbsvm, simhash
    rows = [(i, " ".join(f"w{i}{k}" for k in range(30)), 7.5, 3) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _score double, _row_th long")
    labels = labels_of(spark, [(i, i % 2, 0) for i in range(6)])
    for out in (nbsvm.accepted(docs, labels), simhash.one_of_each(docs)):
        assert out.columns == docs.columns
        assert {(r["_score"], r["_row_th"]) for r in out.collect()} <= {(7.5, 3)}
    assert simhash.one_of_each(docs).count() == 6


def test_signs_that_are_no_letters(spark):
    from cadence.llm import langid
    docs = spark.createDataFrame([(i, "hello there", "en") for i in range(20)] + [(90, "½ ²", "en"), (91, "日", None)],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.digest(docs).collect()}
    assert got[90] == "und" and got[91] == "en"


def test_many_languages_raise(spark, monkeypatch):
    from cadence.llm import langid
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "a b", f"l{i}") for i in range(20)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="lang"):
        langid.fit(docs)


# pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for _, stage in P.STAGES[:-1]:
        docs = P.stored(stage(spark, docs, SF), "stage")
        assert docs.columns == names
    final = P.STAGES[-1][1](spark, docs, SF).collect()
    assert len(final) == docs.count() > 0 and all(r.exact for r in final)
    assert not any(pii.base_spans(r.text) for r in docs.collect())
