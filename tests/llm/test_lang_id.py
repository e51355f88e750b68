import random
import zlib

import numpy as np

from sheafmill.llm.lang_id import BUCKETS, buckets, calibrate, code_points, keep_identified, predict, sums, train

LETTERS = {"aa": "abcdeé ", "bb": "mnopqñ ", "cc": "stuvwü "}


def table(spark, n=240):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        lang = sorted(LETTERS)[i % 3]
        rows.append((i, "".join(rng.choice(LETTERS[lang]) for _ in range(rng.randint(40, 200))), lang if i % 10 else None, 1.0))
    rows += [(n, None, "aa", 1.0), (n + 1, "", "bb", 1.0), (n + 2, "12 34 !?", "cc", 1.0), (None, "abcabc", "aa", 1.0), (0, rows[0][1], "aa", 1.0), (n + 3, "ab" * 400_000, "aa", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"), n


def test_held_out_accuracy(spark):
    docs, n = table(spark)
    model = train(docs)
    rows = predict(docs, model).collect()
    assert len(rows) == n + 6
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (n, n + 1, n + 2):
            assert r.lang_pred == "und"
        elif r.doc_id is not None and r.doc_id < n:
            assert r.lang_pred == sorted(LETTERS)[r.doc_id % 3]
    assert (model.table == 0).mean() > 0.5  # the penalty leaves most weights at zero
    kept = keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == n + 3


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, _ = table(spark)
    lies = docs.selectExpr("doc_id", "text", "case when crc32(cast(doc_id as string)) % 4 = 2 then 'zz' else lang end as lang")
    assert "zz" not in train(lies).classes


def test_blocks_add_up():
    rng = np.random.default_rng(1)
    texts = ["x" * 700_000 + "end", "", "ab", "é"]
    points, at = code_points(texts)
    weights = np.vstack([rng.random((BUCKETS, 2)), np.zeros((1, 2))])
    got = sums(points, at, weights)
    for k, t in enumerate(texts):
        own, ends = code_points([t])
        whole = [weights[b].sum(axis=0) for b in buckets(own, ends, 0, len(own))] if t else [np.zeros(2)]
        grams = sum(max(len(t) - j, 0) for j in range(3))
        assert np.allclose(got[k], sum(whole) / max(grams, 1))


def test_temperature_lowers_the_loss_of_overconfident_scores():
    rng = np.random.default_rng(2)
    labels = rng.integers(0, 3, 400)
    logits = rng.normal(size=(400, 3)) * 8
    logits[np.arange(400), labels] += 6
    assert calibrate(logits, labels) > 1.5


def test_without_labels(spark, empty):
    docs = spark.createDataFrame([(1, "abc", None), (2, "def", None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in predict(docs, train(docs)).collect()} == {("und", 0.0)}
    assert predict(empty, train(empty)).count() == 0
