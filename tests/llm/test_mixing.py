"""The mix: targets, roundings and their balance."""

import random

from pyspark.sql import functions as F

from venuemart.llm import mixing


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, row string, size string, target int")


def targets(sizes, weights=(5, 2, 1), most=3.0):
    """Resharing in rounds, as the definition says."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, rest, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
        rest -= sum(out[s] for s in over)
        free -= over
    return out


def corpus():
    rng = random.Random(2)
    rows = []
    for k in range(400):
        source = rng.choice(["a", "a", "a", "a", "b", "z", "é", "B", None])
        rows.append((k, " ".join("w" * rng.randint(1, 3) for _ in range(rng.choice([0, 1, 5, 30, 200]))), source, "r", "s", 0))
    return rows + [(400, None, "a", "r", "s", 0), (None, "x y", "b", "r", "s", 0), (7, rows[7][1], rows[7][2], "r", "s", 0), (401, "", "empty", "r", "s", 0), (402, "w " * 100_000, "q", "r", "s", 0)]


def test_mix(spark):
    rows = corpus()
    want = {}
    for r in rows:
        want[r[2]] = want.get(r[2], 0) + len((r[1] or "").split())
    goal = targets(want)
    source_of = {r[0]: r[2] for r in rows}
    for leaf, fan in ((4096, 64), (8, 2)):
        out = mixing.mix_sizes(frame(spark, rows), leaf=leaf, fan=fan).collect()
        assert len(out) == len(rows)
        taken, largest = {}, {}
        for r in out:
            s = source_of[r.doc_id]
            assert r.source_size == want[s] and abs(r.target - goal[s]) < 1e-6 * max(1, goal[s])
            assert r.taken <= 3 * r["size"] and (not r["size"] or r.taken % r["size"] == 0)
            taken[s] = taken.get(s, 0) + r.taken
            largest[s] = max(largest.get(s, 0), r["size"])
        assert all(abs(taken[s] - goal[s]) <= largest[s] for s in goal)
        again = mixing.mix_sizes(frame(spark, rows).repartition(3, F.rand(1)), leaf=leaf, fan=fan).collect()
        assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_every_document_has_the_same_chance(spark):
    rows = [(k, "w " * (1 + k % 5), "a" if k % 4 else "b", "", "", 0) for k in range(200)]
    expected = mixing.mix_sizes(frame(spark, rows)).select("doc_id", F.expr("target / source_size * size")).collect()
    expected = dict(map(tuple, expected))
    total = dict.fromkeys(expected, 0)
    for seed in range(6):
        for r in mixing.mix_sizes(frame(spark, rows), leaf=64, seed=seed).collect():
            total[r.doc_id] += r.taken
    # The mean over all documents of a kind of size; single ones vary.
    for n in range(5):
        ids = [k for k in expected if k % 5 == n]
        assert abs(sum(total[k] for k in ids) / 6 / sum(expected[k] for k in ids) - 1) < 0.15


def test_mixed_rows(spark):
    rows = corpus()
    out = mixing.mix(frame(spark, rows))
    assert out.columns == frame(spark, []).columns
    sizes = {r.doc_id: r.taken for r in mixing.mix_sizes(frame(spark, rows)).where("doc_id != 7 and size > 0").collect()}
    got = {}
    for r in out.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len((r.text or "").split())
    assert {k: v for k, v in got.items() if k not in (7, None) and v} == {k: v for k, v in sizes.items() if k is not None and v}


def test_nothing_and_no_words(spark):
    assert mixing.mix_sizes(frame(spark, [])).collect() == []
    out = mixing.mix_sizes(frame(spark, [(1, "", "a", "", "", 0), (2, None, None, "", "", 0)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in out] == [(0, 0, 0.0, 0)] * 2
