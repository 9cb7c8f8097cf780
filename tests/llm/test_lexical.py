"""Ranked search against a plain computation from the contract."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from venuemart.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, best=50):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, k, i if known else None, -s) for k, (s, known, i) in enumerate(sorted(scored)[:best], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def made(rng, n):
    words = [f"w{k}" for k in range(300)] + ["Größe", "été", "NAÏVE", "naïve", "日本", "a", "A"]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([1, 3, 20, 20, 200])))) for k in range(n)]
    docs += [(n + k, "w1 w2 copy of a hot text") for k in range(n // 2)]
    docs += [(None, "w1 w5"), (None, "w1 w5"), (3, "w7 w7 w7"), (3, "w7 w7 w7"), (-4, None), (-5, ""), (-6, " .,!\x00"), (-7, "x" * 100_000), (-8, "w9 " * 50_000)]
    return docs


ITEMS = [(0, "w1 W1 w2-copy, hot"), (1, "naïve Naïve été 日本 größe"), (2, None), (3, ""), (4, "unseen"), (5, "w7 w9 a " + " ".join(f"w{k}" for k in range(40))), (5, "w7"), (None, "w1"), (6, "x" * 100_000)]


@pytest.mark.parametrize("shard, shard_terms, best", [(16384, 10**6, 50), (7, 10**6, 3), (1000, 50, 50)])
def test_against_brute_force(spark, shard, shard_terms, best):
    docs = made(random.Random(1), 300)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, term string, shard int").repartition(3)
    items = spark.createDataFrame([(i, t, 5) for i, t in ITEMS], "item_id bigint, text string, key int")
    index = lexical.build(df, shard=shard, shard_terms=shard_terms)
    assert rows(lexical.search(index, items, best=best)) == brute(docs, ITEMS, best)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 10)
    docs = made(random.Random(2), 60)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(lexical.ranked_search(df, spark.createDataFrame(ITEMS, "item_id bigint, text string"))) == brute(docs, ITEMS)


@pytest.mark.parametrize("docs, items", [([], ITEMS), ([(1, "w1")], []), ([], []), ([(1, None), (2, " ")], ITEMS)])
def test_nothing(spark, docs, items):
    out = lexical.ranked_search(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_terms_and_counts():
    texts = ["", "a", " a", "B1_c", "a\x7fb", "é", "x  ", "\x00", "tail x", "y"]
    for part in (pa.array(texts), pa.array(["zz", *texts, "q"]).slice(1, len(texts))):
        words, of = lexical.terms_of(part)
        assert list(zip(words.to_pylist(), of.tolist(), strict=True)) == [(w, k) for k, t in enumerate(texts) for w in terms(t)]
        assert lexical.counts_of(part).tolist() == [len(terms(t)) for t in texts]


def test_bounds_leave_strata_unvisited_and_lists_exact():
    """One short document has all terms; long documents cannot reach it."""
    texts = ["p q r"] + [f"p {'f ' * (20 * k)}" for k in range(1, 200)]
    words, of = lexical.terms_of(pa.array(texts))
    parts = list(lexical._shard(0, words, of, pa.array(range(len(texts))), len(texts), len(words)))
    shard = lexical.Shard(pa.Table.from_batches(parts))
    place, score, visited = shard.best({"p": 5, "q": 900, "r": 900}, 1)
    assert shard.ids[place].tolist() == [0] and visited < len(shard.norms) / 4
    everything = lexical.Shard(pa.Table.from_batches(parts)).best({"p": 5, "q": 900, "r": 900}, 1000)
    assert len(everything[0]) == 200 and everything[1][0] == score[0]
    assert np.all(np.diff(everything[1]) <= 0)
