"""The label scorer against a plain computation over all rows."""

import os
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart import schemas
from venuemart.lexicons import SCORE_LABELS
from venuemart.ml import labels
from venuemart.plans import jobs, reviews

SF = "/root/testdata/sf0.001"
BUCKETS = 512
WORDS = {"negative": "awful cold rude", "positive": "great warm tasty", "neutral": "table street menu", "skip": "qqq zzz 123", "speech": "hello thanks bye"}


def texts(n):
    rng = random.Random(4)
    out = [(" ".join(rng.choices((WORDS[x] + " and the of").split(), k=rng.randint(3, 12))), x) for x in SCORE_LABELS for _ in range(n)]
    return [*out, ("Ünï-code " * 40, "skip"), ("", "skip"), (None, "speech"), ("great", "other"), ("great", None)]


def brute_row(text):
    row = np.zeros(BUCKETS)
    row[crc32(b" ") % BUCKETS] += 1
    for word in re.findall(r"\w+", (text or "").lower()):
        row[crc32(f" {word}".encode()) % BUCKETS] += 1
        marked = f"<{word}>"
        for n in (3, 4, 5):
            for i in range(max(0, len(marked) - n + 1)):
                row[crc32(marked[i : i + n].encode()) % BUCKETS] += 1
    return row / row.sum()


def brute_fit(rows, epochs, width, rate):
    x = np.array([brute_row(t) for t, _ in rows])
    y = np.eye(5)[[SCORE_LABELS.index(k) for _, k in rows]]
    v, w = np.random.default_rng(0).uniform(-1, 1, (width, BUCKETS)) / width, np.zeros((width, 5))
    means, squares = [0 * v, 0 * w], [0 * v, 0 * w]
    for step in range(1, epochs + 1):
        e = np.exp(x @ v.T @ w)
        off = (e / e.sum(axis=1, keepdims=True) - y) / len(rows)
        grads, new = [(x.T @ off @ w.T).T, (x @ v.T).T @ off], []
        for k, (now, g) in enumerate(zip((v, w), grads)):
            means[k] = 0.9 * means[k] + 0.1 * g
            squares[k] = 0.999 * squares[k] + 0.001 * g * g
            new.append(now - rate * means[k] / (1 - 0.9**step) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8))
        v, w = new
    return lambda text: (lambda e: e / e.sum())(np.exp(brute_row(text) @ v.T @ w))


def test_scores_of_five_labels(spark, tmp_path):
    rows = texts(12)
    df = spark.createDataFrame(rows, "review string, label string").repartition(3)
    model = labels.fit(df, "review", "label", SCORE_LABELS, epochs=30, batches=1, rate=0.1, buckets=BUCKETS, width=4)
    model.save(spark, str(tmp_path / "model"))
    again = labels.LabelModel.load(spark, str(tmp_path / "model"))
    assert again.labels == SCORE_LABELS and np.array_equal(again.logits, model.logits)

    truth = brute_fit([r for r in rows if r[1] in SCORE_LABELS], 30, 4, 0.1)
    got = labels.scorer(again)(df.withColumn("skip", F.lit("own")), "review").collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.allclose([r[x] for x in SCORE_LABELS], truth(r.review), atol=1e-9)
    known = [r for r in got if r.label in SCORE_LABELS and r.review and r.label != "skip"]
    assert sum(max(SCORE_LABELS, key=lambda x: r[x]) == r.label for r in known) >= 0.9 * len(known)


def test_scorer_gives_text_features_all_labels(spark):
    df = spark.createDataFrame([("Great, warm!",), (None,)], "review string")
    logits = np.random.default_rng(1).normal(size=(5, BUCKETS))
    out = reviews.text_features(df, "review", scorer=labels.scorer(labels.LabelModel(SCORE_LABELS, logits)))
    for r in out.collect():
        assert abs(sum(r[x] for x in SCORE_LABELS) - 1) < 1e-12 and min(r[x] for x in SCORE_LABELS) > 0


def test_labels_of_nothing(spark):
    df = spark.createDataFrame([], "review string, label string")
    model = labels.fit(df, "review", "label", SCORE_LABELS, epochs=1, buckets=8, width=2)
    assert not model.logits.any()
    assert labels.scorer(model)(df, "review").collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_languages_of_documents_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    names = sorted(r.lang for r in docs.select("lang").distinct().collect() if r.lang)
    model = labels.fit(docs.where("doc_id % 4 <> 0"), "text", "lang", names)
    got = labels.scorer(model)(docs.where("doc_id % 4 = 0 AND length(text) > 200"), "text").collect()
    assert sum(max(names, key=lambda x: r[x]) == r.lang for r in got) >= 0.9 * len(got) > 9


def test_label_model_job(spark, tmp_path):
    paths = {k: str(tmp_path / k) for k in ("train", "model", "in", "out")}
    spark.createDataFrame(texts(2), "review string, label string").write.parquet(paths["train"])
    jobs.train_label_model(spark, paths["train"], paths["model"], epochs=1, batches=1, buckets=BUCKETS, width=2)
    fields = [f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in T.StructType.fromDDL(schemas.SENTENCE).fields if f.name != "review"]
    spark.sql(f"SELECT 'Great and warm' AS review, {', '.join(fields)}").write.parquet(paths["in"])
    jobs.create_text_features(spark, paths["in"], paths["out"], label_model=paths["model"])
    (row,) = spark.read.parquet(paths["out"]).collect()
    assert abs(sum(row[x] for x in SCORE_LABELS) - 1) < 1e-9 and row.skip > 0


def test_features_of_rare_words_are_found_together(monkeypatch):
    """One call per different word, whatever its n-grams; counts as of the plain computation, in groups of texts too."""
    rows = [*[t for t, _ in texts(3)], "ab a ß 日本語 x" * 9, "İstanbul 𝒳𝒴𝒵 " * 20, *[f"rare{i}" for i in range(300)]]
    different = {w for t in rows for w in re.findall(r"\w+", (t or "").lower())}
    for letters in (1 << 20, 40):
        monkeypatch.setattr(labels, "LETTERS", letters)
        for row, (ids, counts) in zip(rows, labels.features_of(rows, BUCKETS), strict=True):
            dense = np.zeros(BUCKETS)
            dense[ids] = counts
            assert np.allclose(dense / dense.sum(), brute_row(row)) and (np.diff(ids) > 0).all()
    assert [len(ids) for ids, _ in labels.features_of([None, "", " ."], BUCKETS)] == [1, 1, 1]
    called = []
    monkeypatch.setattr(labels, "LETTERS", 1 << 20)
    monkeypatch.setattr(labels, "crc32", lambda x: called.append(x) or crc32(x))
    list(labels.features_of(rows, BUCKETS))
    assert len(called) <= len(different) + 1
