"""The whole pipeline against a plain Python chain: scores of the fitted model,
components, contamination and redaction by brute force, decoded ids."""

import random

import xxhash
from test_simhash import brute_components, brute_fp
from test_text_operators import brute_contamination

import corpus_pipeline
from cadence.llm import nbsvm, sentencepiece_unigram

PRIVATE = {"a.b@c.de": "email", "192.168.7.20": "ip", "4111 1111 1111 1111": "card", "+1 (632) 555-4827": "phone",
           "DE89 3704 0044 0532 0130 00": "iban"}


def tables():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeimnorstu") for _ in range(r.randint(2, 8)))
    words = [word() for _ in range(400)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(i, line(r.choice([13, 20, 9]))) for i in range(6)]
    good = [f"{line(r.randint(60, 200))}.\n{line(30)}" for _ in range(40)]
    bad = [" ".join(r.choice(["BUY", "$$$", "!!!", "NOW", "#", "WIN WIN"]) for _ in range(r.randint(60, 150))) for _ in range(16)]
    texts = [t for pair in zip(good, bad + [None] * 24, strict=True) for t in pair if t is not None]
    rows = list(enumerate(texts))
    labels = [(i, int(t in good), 0) for i, t in rows]
    at = len(rows)
    for k, (v, _) in enumerate(PRIVATE.items()):
        rows.append((at + k, f"{line(70)} {v} BIC {line(20)}"))
    for i in range(6):
        rows.append((100 + i, f"{line(20)} {items[i][1]} {line(15)}"))
        rows.append((120 + i, f"{items[i][1]} {line(900)}"))  # less than five percent
        w = good[i].split(" ")
        w[5] = "other"
        rows += [(140 + i, good[i]), (160 + i, " ".join(w))]
    rows += [(200, None), (201, ""), (None, line(80)), (7, line(90)), (7, line(95))]
    r.shuffle(rows)
    return rows, labels, items


def test_run_equals_a_plain_chain(spark, tmp_path):
    rows, labels, items = tables()
    docs = spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = nbsvm.fit(docs, labelled)
    fine = [(i, t) for i, t in rows if nbsvm.score_text((t or "").encode(), model) >= 0.5]
    groups = {}
    for row, c in zip(fine, brute_components([brute_fp(t) for _, t in fine]), strict=True):
        groups.setdefault(c, []).append(row)
    th = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) + 2**63) % 2**64  # noqa: E731 - in the order of signed longs
    heads = [min(g, key=lambda x: (x[0] is None, x[0] or 0, th(x[1]))) for g in groups.values()]
    clean = [x for x in heads if not brute_contamination([x], items, 13)[0][-1]]
    assert len(rows) > len(fine) > len(heads) > len(clean) > 40  # every stage has something to do
    want = []
    for i, t in clean:
        for value, kind in PRIVATE.items():
            t = (t or "").replace(value, f"<{kind}>")
        want.append((str(i), t))
    assert sum("<" in t for _, t in want) == len(PRIVATE)

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    unigram = sentencepiece_unigram.Unigram.load()
    assert all(x.exact and x.n_tokens == len(x.ids) for x in out)
    assert sorted((str(x.doc_id), unigram.decode(list(x.ids))) for x in out) == sorted(want)
