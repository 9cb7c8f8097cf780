"""Whole texts in parts, and sketches, against plain computations."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from venuemart.operators import sketches, whole


def brute_parts(rows, size, glue):
    out = {}
    at = Counter()
    for k, p, t in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        part = out.setdefault((k, at[k] // size), [at[k], []])
        part[1].append(t)
        at[k] += len(t) + len(glue)
    return sorted(((k, p, s, glue.join(t)) for (k, p), (s, t) in out.items()), key=repr)


@pytest.mark.parametrize("glue", [".", "", " / "])
def test_parts_of_a_giant_key(spark, glue):
    rng = random.Random(2)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, "x" * rng.randint(0, 9) + "é") for i in range(3000)]
    rows += [(None, 1, "a"), (None, 2, None), (None, 3, "b"), ("long", 1, "y" * 5000), ("long", 2, "z"), ("tie", 1, "b"), ("tie", 1, "a"), ("none", 1, None)]
    df = spark.createDataFrame(rows, "id string, n int, words string").repartition(5)
    got = whole.text_parts(df, "id", "n", "words", 100, glue)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_parts(rows, 100, glue)
    hot = sorted((r.part, r.words) for r in got.where("id = 'hot'").collect())
    assert len(hot) > 100 and max(len(t) for _, t in hot) <= 100 + 10
    assert glue.join(t for _, t in hot) == glue.join(t for k, _, t in rows if k == "hot")


def test_parts_of_nothing(spark):
    assert whole.text_parts(spark.createDataFrame([], "id int, n int, words string"), "id", "n", "words").collect() == []


def test_frequent_values_within_the_bound(spark):
    rng = random.Random(5)
    values = [min(int(rng.paretovariate(0.8)), 10**6) for _ in range(30_000)]
    rows = [(v, i % 3) for i, v in enumerate(values)] + [(None, 0)] * 500
    df = spark.createDataFrame(rows, "v long, source int")
    per_source = sketches.value_sketches(df, "v", ["source"], tracked=300)
    got = sketches.frequent_values(sketches.merged(per_source, tracked=300), "v", 20).collect()
    exact = Counter(values)
    off = sketches.count_error(len(rows), 300)
    assert len(got) == 20 and got[0]["rows"] == len(values)
    assert all(abs(r["count"] - exact[r.v]) <= off for r in got)
    assert all(v in {r.v for r in got} for v, n in exact.items() if n > sorted(exact.values())[-20] + 2 * off)


def test_frequent_values_are_exact_when_few(spark):
    df = spark.range(1000).select(F.concat(F.lit("v"), F.col("id") % 7).alias("v"))
    got = sketches.frequent_values(sketches.value_sketches(df, "v", tracked=100), "v", 3).collect()
    assert sorted(r["count"] for r in got) == [143, 143, 143]


def test_bins_of_equal_share(spark):
    df = spark.range(20_000).select((F.col("id") * F.col("id")).cast("double").alias("x"), (F.col("id") % 2).alias("side"))
    got = sketches.equal_share_bins(sketches.quantile_sketches(df, "x", ["side"]), 4).collect()
    assert sorted((r.side, r.bin) for r in got) == [(s, b) for s in (0, 1) for b in range(4)]
    for r in got:
        share = (r.high**0.5 - r.low**0.5) / 20_000
        assert abs(share - 0.25) < 0.01
