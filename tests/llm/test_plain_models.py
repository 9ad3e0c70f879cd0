"""Scores of the two classifiers against plain Python, from the fitted model
down to every indicator; and the pipeline on empty tables."""

import math

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cadence.llm import common, langid, nbsvm

SF = "/root/testdata/sf0.001"
EDGE = ["", " \n\t ", "x", "Ünï cödé ▁ 日本語", "one two three " * 40, "a a a b a a a b", "\0\x1f", "1234", "BUY !!! $$$ now"]
FULL = 2 ** 64 - 1


def plain_indicators(text):
    """Sets of ("word" or "pair", hash), runs of classes, and marks, as numbers."""
    body = text.encode()
    words = body.split()
    if not words:
        return set()
    classes = []
    for c in body:
        ch = chr(c)
        classes.append(0 if "a" <= ch <= "z" else 1 if "A" <= ch <= "Z" else 2 if "0" <= ch <= "9" else
                       3 if ch in " \t\v\f\r" else 4 if ch == "\n" else 5 if ch in "!?" else
                       6 if ch in "#*$%&|<>@=+~^_{}[]\\/" else 7 if ch in ".,;:-'\"()`" else 8)
    mul = 0x9E3779B97F4A7C15
    h = [xxhash.xxh3_64_intdigest(w) for w in words]
    pairs = [(a * mul + b) & FULL for a, b in zip(h, h[1:], strict=False)]
    out = {(x * mul & FULL) >> 47 for x in h + pairs}
    for i in range(len(classes) - 4):
        n = 0
        for c in classes[i:i + 5]:
            n = n * 9 + c
        out.add((1 << 17) + n)
    marks = [int(i > 0 and words[i] == words[i - 1]) for i in range(len(words))]
    seen = set()
    for i in range(2, len(words)):
        three = tuple(words[i - 2:i + 1])
        marks[i] += 2 * (three in seen)
        seen.add(three)
    for i in range(len(marks) - 2):
        out.add((1 << 17) + 9 ** 5 + marks[i] * 16 + marks[i + 1] * 4 + marks[i + 2])
    return out


@pytest.fixture(scope="module")
def docs(spark):
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([*EDGE, None])], "doc_id long, text string")
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").unionByName(
        extra.withColumn("lang", F.lit(None).cast("string")))


def test_quality_scores_equal_plain_scores(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights, scale, bias = model = nbsvm.fit(docs, labels)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r["_score"] for r in nbsvm.score(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        s = sorted(plain_indicators(t or ""))
        margin = bias
        if s:
            margin += math.fsum(map(float, weights[s])) / max(1e-9, math.sqrt(math.fsum(map(float, scale[s]))))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-max(-30.0, min(30.0, 2 * margin)))), abs=1e-9)


def test_log_ratios_equal_plain_counts(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = [(bytes(r.body).decode(), r.y) for r in common.labelled_rows(docs, labels, "quality", 10_000).collect()]
    good = sum(y == 1 for _, y in rows)
    count = {}
    for t, y in rows:
        for k in plain_indicators(t):
            count.setdefault(k, [0, 0])[int(y == 1)] += 1
    scale = nbsvm.fit(docs, labels)[1]
    for k, (b, g) in count.items():
        ratio = math.log((g + 1) / (good + 2) / ((b + 1) / (len(rows) - good + 2)))
        assert float(scale[k]) == pytest.approx(ratio ** 2, rel=1e-5, abs=1e-9)


def plain_language(text, model):
    body = text.encode()
    body = bytes(c + 32 if 65 <= c <= 90 else c for c in body)
    low = 2 ** 32 - 1
    cell = [0.0] * 4096
    for i, c in enumerate(body):
        cell[((c * 0x9E3779B1 + 1) & low) >> 20] += 1
        if i + 1 < len(body):
            two = c * 257 + body[i + 1]
            cell[((two * 0x85EBCA6B + 2) & low) >> 20] += 1
            if i + 2 < len(body):
                cell[(((two * 263 + body[i + 2]) * 0xC2B2AE35 + 3) & low) >> 20] += 1
    total = sum(cell)
    x = {i: math.sqrt(v / total) for i, v in enumerate(cell) if v}
    loss = []
    for word in model.code.tolist():
        at = 0.0
        for bit, sign in enumerate(word):
            margin = float(model.bias[bit]) + math.fsum(v * float(model.weights[i, bit]) for i, v in x.items())
            at += math.log1p(math.exp(-sign * margin)) * float(model.trust[bit])
        loss.append(at)
    best = min(range(len(loss)), key=lambda k: (loss[k], k))
    return model.languages[best], 1 / sum(math.exp(loss[best] - v) for v in loss)


def test_languages_equal_plain_decoding(spark, docs):
    model = langid.fit(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        if not any(c.isalpha() for c in t or ""):
            assert (got[i].lang_pred, got[i].score, got[i].ambiguous) == ("und", 0.0, False)
            continue
        lang, share = plain_language(t, model)
        assert got[i].score == pytest.approx(share, abs=1e-4)
        assert got[i].lang_pred == lang and got[i].ambiguous == (got[i].score < 0.6)


def test_pipeline_on_empty_tables(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("1 = 0").write.parquet(f"{tmp_path}/{t}.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "ids", "n_tokens", "exact"] and out.collect() == []
