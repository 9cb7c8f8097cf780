"""The corpus pipeline, stage by stage, against brute force on the smallest tables."""

import hashlib
import os
from collections import Counter

import pytest

import corpus_pipeline
from test_dedup import brute_components, brute_fingerprint, lines_truth
from venuemart.llm import common, mixing, queries, recipe

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = common.mark()
        docs = common.stored(stage(spark, docs, SF), "stage")
        common.release(spark, before, common.mark() - 1)
        seen.append(docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == names
    good, own, distinct, mixed, tokens = ([r.asDict() for r in x.collect()] for x in seen)

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    assert 0 < len(good) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert sum(d in kept for d, q in labels.items() if q) > 0.97 * sum(labels.values())

    want = lines_truth([(r["doc_id"], r["text"]) for r in good], 10)
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in own), key=repr) == sorted(((i, t, len(t)) for i, _, _, t in want), key=repr)

    ids = sorted(r["doc_id"] for r in own)
    text = {r["doc_id"]: r["text"] for r in own}
    groups = brute_components([(i, brute_fingerprint(text[i])) for i in ids])
    assert sorted(r["doc_id"] for r in distinct) == sorted(set(groups))

    taken = Counter(r["doc_id"] for r in mixed)
    sizes = {r.doc_id: (r["size"], r.taken) for r in mixing.mix_sizes(seen[2]).collect()}
    assert {i: n * sizes[i][0] for i, n in taken.items() if sizes[i][0]} == {i: t for i, (_, t) in sizes.items() if t}

    held = recipe.vocabulary()
    texts = Counter((r["doc_id"], tuple(held.encode(r["text"])), hashlib.sha256(r["text"].encode()).hexdigest()) for r in mixed)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in tokens) == texts
    assert all(r["exact"] for r in tokens)


def test_run_gives_the_last_stage(spark):
    out = queries.QUERIES["pipeline"](spark, SF)
    assert out.columns == ["doc_id", "ids", "n_ids", "decoded_sha256", "exact"] and out.count() > 0


def test_stages_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in queries.QUERIES}
