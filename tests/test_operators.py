"""Joins, ids and statistics against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from venuemart.lexicons import EARTH_RADIUS
from venuemart.operators import explore, ids, lemmas, match, mentions, skew, stats
from venuemart.plans.listing import review_sentences


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def haversine(a, b):
    (x1, y1), (x2, y2) = ([math.radians(v) for v in p] for p in (a, b))
    h = math.sin((y2 - y1) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x2 - x1) / 2) ** 2
    return 2 * EARTH_RADIUS * math.asin(math.sqrt(min(1.0, h)))


# --- skew -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left"])
def test_skew_join_equals_plain_join(spark, how):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 > 0, F.col("id") % 40).alias("k"))
    dims = spark.createDataFrame([(1, "a"), (1, "b"), (7, "c"), (99, "d"), (None, "e")], "k long, v string")
    plain = facts.join(dims, "k", how).select("k", "id", "v")
    balanced = skew.skew_join(facts, dims, ["k"], how, hot_rows=20).select("k", "id", "v")
    assert rows(balanced) == rows(plain)


def test_skew_join_spreads_a_hot_key(spark):
    facts = spark.range(20000).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k"))
    dims = facts.select("k").distinct().withColumn("v", F.col("k") + 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.skew_join(facts, dims, ["k"], hot_rows=1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 20000
    assert len(sizes) == 4 and max(sizes) < 9000


def test_equal_rows_of_a_key_spread(spark):
    """100,000 identical rows: all tasks that the key is dealt to get their share."""
    facts = spark.range(100_000, numPartitions=4).select(F.lit(1).alias("k"), F.lit("same").alias("t"))
    dims = spark.createDataFrame([(1, "a")], "k int, v string")
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert [(r.k, r._salts) for r in skew.hot_keys(counts, ["k"], 2000).collect()] == [(1, 50)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        joined = skew.skew_join(facts, dims, ["k"], hot_rows=2000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    # Fifty shares of about 2,000 rows fall on 64 tasks by their hash.
    assert sum(sizes) == 100_000 and len(sizes) > 25 and max(sizes) < 13_000


def test_group_values(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "y"), ("b", "z"), (None, "w")], "k string, v string")
    got = skew.with_group_values(df, ["k"], n=F.count("v"), top=F.max("v"))
    assert rows(got) == rows(spark.createDataFrame([("a", "x", 1, "x"), ("a", None, 1, "x"), (None, "y", None, None), ("b", "z", 1, "z"), (None, "w", None, None)], "k string, v string, n long, top string"))


@pytest.mark.parametrize("limit", [0, 100])
def test_lookup_join_both_ways(spark, limit):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "t string, i int")
    table = spark.createDataFrame([("a", "A")], "t string, l string")
    assert rows(skew.lookup_join(df, table, ["t"], rows=limit).select("t", "i", "l")) == [("a", 1, "A"), ("a", 3, "A")]


# --- distance and names -----------------------------------------------------------------------------------


def points(n, seed, box):
    rnd = random.Random(seed)
    return [(i, rnd.uniform(*box[0]), rnd.uniform(*box[1])) for i in range(n)]


@pytest.mark.parametrize(
    "box, radius",
    [
        (((37.3, 37.5), (55.5, 55.6)), 700.0),
        (((179.9, 180.1), (10.0, 10.1)), 2000.0),
        (((-180.0, 180.0), (89.9, 90.0)), 3000.0),
        (((-180.0, 180.0), (-90.0, -89.9)), 3000.0),
        (((-180.0, 180.0), (-90.0, 90.0)), 2_000_000.0),
    ],
)
def test_distance_join_equals_all_pairs(spark, box, radius):
    wrap = lambda ps: [(i, x - 360 if x > 180 else x, y) for i, x, y in ps]
    left, right = wrap(points(120, 1, box)), wrap(points(80, 2, box)) + [(80, None, 5.0)]
    a = spark.createDataFrame(left, "a long, x_coord double, y_coord double")
    b = spark.createDataFrame(right, "b long, x_coord double, y_coord double")
    got = {(r.a, r.b) for r in match.distance_join(a, b, radius).collect()}
    want = {(i, j) for i, *p in left for j, *q in right[:80] if haversine(q, p) <= radius}
    assert got == want and want


def brute_match(listing, register, radius):
    best = {}
    for k, x, y, title in listing:
        for g, rx, ry, name in register:
            if None in (x, y, title, rx, ry, name) or not (name in title or title in name):
                continue
            d = haversine((rx, ry), (x, y))
            if d <= radius and (k not in best or (d, g) < best[k]):
                best[k] = (d, g)
    return {k: g for k, (d, g) in best.items()}


def match_case(seed):
    rnd = random.Random(seed)
    names = ["аб", "абв", "бв", "зал", "зал 1", "зал 12", "", "x", "бар зал", "пицца", "izakaya", "the izakaya bar", None]
    place = lambda: (round(rnd.uniform(37.60, 37.61), 3), round(rnd.uniform(55.70, 55.71), 3))
    listing = [(i, *place(), rnd.choice(names)) for i in range(150)] + [(900, None, 55.7, "зал")]
    register = [(i, *place(), rnd.choice(names)) for i in range(100)] + [(900, 37.6, None, "зал")]
    return listing, register


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("partitions", [1, 7])
def test_match_equals_all_pairs(spark, seed, partitions):
    listing, register = match_case(seed)
    a = spark.createDataFrame(listing, "k long, x_coord double, y_coord double, title_norm string").repartition(partitions)
    b = spark.createDataFrame(register, "global_id long, x_coord double, y_coord double, Name_norm string").repartition(partitions)
    got = {r.k: r.global_id for r in match.match_listing(a, b, 200.0).collect()}
    assert got == brute_match(listing, register, 200.0)
    assert len(got) > 50


def test_match_of_empty_sides(spark):
    a = spark.createDataFrame([], "k long, x_coord double, y_coord double, title_norm string")
    b = spark.createDataFrame([(1, 1.0, 1.0, "a")], "global_id long, x_coord double, y_coord double, Name_norm string")
    assert match.match_listing(a, b).count() == 0


def test_crowded_place_does_not_pair_everything(spark):
    """2,000 different names at one spot: candidates stay near the number of true matches."""
    a = spark.range(2000).select("id", F.lit(37.6).alias("x_coord"), F.lit(55.7).alias("y_coord"), F.concat(F.lit("бар "), F.sha2(F.col("id").cast("string"), 256)).alias("title_norm"))
    b = a.select(F.col("id").alias("global_id"), "x_coord", "y_coord", F.col("title_norm").alias("Name_norm"))
    got = match.match_listing(a, b)
    assert got.where("id = global_id").count() == got.count() == 2000


def test_copies_of_one_venue_are_split(spark):
    """A third of the listing is one venue: its copies are matched once, and the join back is cut into pieces."""
    copies = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    listing = spark.range(30000).select(
        "id", (F.lit(37.0) + copies / 30000).alias("x_coord"), F.lit(55.7).alias("y_coord"), F.concat(F.lit("зал "), copies).alias("title_norm"),
        F.sha2(F.col("id").cast("string"), 512).alias("review"),
    )
    register = listing.where("id < 3000").select(F.col("id").alias("global_id"), "x_coord", "y_coord", F.col("title_norm").alias("Name_norm"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        matched = match.match_listing(listing.repartition(8), register, 5.0)
        got = matched.collect()
        plan = matched._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r.global_id == 0 for r in got) == 10000 and len(got) == 10000 + 2000
    assert "skew=true" in plan


# --- ids --------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_first_per_key(spark, partitions):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(partitions)
    assert rows(ids.first_per_key(df, ["k"], [F.desc("v")])) == [(k, max(v for v in range(1000) if v % 7 == k)) for k in range(7)]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_sentence_ids_do_not_depend_on_the_layout(spark, partitions):
    data = [(i % 5, f"Раз {i}. Два.  . {i}", f"u{i}") for i in range(60)] + [(1, None, "v"), (2, " . ", "w")]
    df = spark.createDataFrame(data, "global_id long, review string, url string").repartition(partitions)
    got = review_sentences(df, "s").collect()
    want = []
    for g, review, url in sorted((d for d in data if d[1]), key=lambda d: (d[0], d[2], d[1])):
        want += [(g, part, url) for part in review.split(".") if part.strip()]
    assert [(r.sentence_id, r.global_id, r.review, r.url) for r in sorted(got, key=lambda r: r.sentence_id)] == [
        (i, *w) for i, w in enumerate(want)
    ]


def test_split_is_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") % 10 < 7, "a").otherwise("b"))
    first = ids.train_test_split(df, "id", 0.3, 17, ["y"])
    counts = {(r.y, r.part): r["count"] for r in first.groupBy("y", "part").count().collect()}
    assert counts == {("a", "train"): 490, ("a", "test"): 210, ("b", "train"): 210, ("b", "test"): 90}
    assert rows(ids.train_test_split(df.repartition(13), "id", 0.3, 17, ["y"])) == rows(first)
    assert rows(ids.train_test_split(df, "id", 0.3, 18, ["y"])) != rows(first)


def test_sample_is_repeatable(spark):
    df = spark.range(500)
    assert rows(ids.seeded_sample(df, "id", 20, 17)) == rows(ids.seeded_sample(df.repartition(9), "id", 20, 17))


# --- statistics -------------------------------------------------------------------------------------------


def best_lambda(x):
    x = np.array(x)
    logs = np.log(x)

    def llf(lam):
        y = logs if abs(lam) < 1e-12 else (x**lam - 1) / lam
        return (lam - 1) * logs.sum() - len(x) / 2 * np.log(y.var())

    low, high = -5.0, 5.0
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (a, high) if llf(a) < llf(b) else (low, b)
    return (low + high) / 2


SAMPLE = [1.0, 2, 3, 1, 2, 3, 1, 2, 3, 1, 2, 3, 2.5]


def test_boxcox_lambda_is_the_likeliest(spark):
    rnd = np.random.default_rng(3)
    for x in (SAMPLE, list(map(float, rnd.lognormal(size=80))), list(map(float, rnd.uniform(5, 6, 80)))):
        df = spark.createDataFrame([(float(v),) for v in x] + [(0.0,), (-1.0,), (None,)], "x double")
        assert stats.boxcox_lambda(df, "x").first()["lmbda"] == pytest.approx(best_lambda(x), abs=1e-4)


def test_boxcox_scale(spark):
    df = spark.createDataFrame([(float(v),) for v in SAMPLE] + [(0.0,), (None,)], "x double")
    scaled = [r.y for r in stats.boxcox_scale(df, "x", "y").collect()]
    assert scaled[-2:] == [None, None]
    assert np.mean(scaled[:-2]) == pytest.approx(0, abs=1e-9) and np.std(scaled[:-2]) == pytest.approx(1)
    constant = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r.y for r in stats.boxcox_scale(constant, "x", "y").collect()] == [0.0, 0.0]
    assert stats.boxcox_scale(df.limit(0), "x", "y").count() == 0


def test_boxcox_per_group(spark):
    data = [("a", float(v)) for v in SAMPLE] + [("b", 3.0 * v) for v in SAMPLE] + [("c", 1.0), ("c", 1.0)]
    df = spark.createDataFrame(data, "g string, x double")
    fitted = {r.g: r.lmbda for r in stats.boxcox_lambda(df, "x", ["g"]).collect()}
    assert fitted["a"] == pytest.approx(0.82255, abs=1e-4) and fitted["b"] == pytest.approx(fitted["a"], abs=1e-5)
    assert "c" not in fitted
    scaled = stats.boxcox_scale(df, "x", "y", ["g"]).groupBy("g").agg(F.avg("y"), F.stddev_pop("y"))
    for g, mean, std in rows(scaled):
        assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(0 if g == "c" else 1)


def test_zscore_without_spread_is_zero(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (None,)], "x double")
    assert sorted((r.z for r in stats.zscore(df, "x", "z").collect()), key=repr) == [0.0, 0.0, None]


# --- mentions and reports ---------------------------------------------------------------------------------


def test_dish_mentions(spark):
    df = spark.createDataFrame([(1, 0, "я любить сушить рыба рыба", "s"), (2, 1, "шашлык и гора", "s"), (3, 2, None, "s"), (4, 3, "", "s")], "global_id long, sentence_id long, t string, source string")
    got = rows(mentions.find_mentions(df, "t", ["global_id", "sentence_id"], ["source"]))
    assert got == [(1, 0, "dish", "рыба", 2, "s"), (1, 0, "dish", "суши", 1, "s"), (2, 1, "dish", "шашлык", 1, "s")]
    table = spark.createDataFrame([("сушить", "суши"), ("рыба", "рыба"), ("шашлык", "шашлык")], "lemma string, value string")
    assert rows(mentions.find_mentions(df, "t", ["global_id", "sentence_id"], ["source"], table)) == got
    none = mentions.find_mentions(df.where("global_id > 2"), "t", ["global_id", "sentence_id"])
    assert none.columns == ["global_id", "sentence_id", "aspect", "value", "count"] and none.count() == 0


def test_lemmatise(spark):
    df = spark.createDataFrame([(1, "мама готовила рыбу рыбу"), (2, ""), (3, None), (None, "рыбу")], "k long, t string")
    lemmas = spark.createDataFrame([("готовила", "готовить"), ("рыбу", "рыба")], "token string, lemma string")
    want = sorted([(1, "мама готовить рыба рыба"), (2, ""), (3, None), (None, "рыба")], key=repr)
    assert rows(mentions.lemmatise(df, "t", lemmas, "n").select("k", "n")) == want
    assert rows(mentions.lemmatise(df, "t", lemmas, "n", rows=1).select("k", "n")) == want
    known = {"готовила": "готовить", "рыбу": "рыба"}
    assert rows(mentions.lemmatise_with(df, "t", lambda w: known.get(w, w), "n").select("k", "n")) == want


def test_lemma_given_twice(spark):
    df = spark.createDataFrame([(1, "b a b")], "k long, t string")
    lemmas = spark.createDataFrame([("b", "z"), ("b", "c"), ("a", None), (None, "x")], "token string, lemma string")
    for most in (256, 0):
        assert mentions.lemmatise(df, "t", lemmas, "n", rows=most).first().n == "c a c"


def brute_rules(pairs, context, longest):
    votes = {}
    for token, lemma in {p for p in pairs if p[0] and p[1] is not None}:
        stem = 0
        while stem < min(len(token), len(lemma)) and token[stem] == lemma[stem]:
            stem += 1
        cut = len(token) - stem
        for n in range(max(cut, 1), min(cut + context, len(token)) + 1):
            if n <= longest:
                held = votes.setdefault(token[-n:], {})
                held[cut, lemma[stem:]] = held.get((cut, lemma[stem:]), 0) + 1
    return {s: min((-v, c, e) for (c, e), v in held.items()) for s, held in votes.items()}


def test_suffix_rules_against_brute_force(spark):
    rng = random.Random(11)
    stems = ["".join(rng.choices("абвгд", k=rng.randint(0, 6))) for _ in range(80)]
    pairs = [(s + a, s + b) for s in stems for a, b in rng.sample([("ами", ""), ("ов", ""), ("ый", "ый"), ("ая", "ый"), ("ы", "а"), ("", "ть"), ("шли", "идти")], 3)]
    pairs += [("пошли", "идти"), ("", "x"), (None, "x"), ("x", None), *pairs[:5]]
    table = spark.createDataFrame(pairs, "token string, lemma string")
    rules = lemmas.suffix_rules(table)
    want = brute_rules(pairs, lemmas.CONTEXT, lemmas.LONGEST)
    assert {r.suffix: (-r.votes, r.cut, r.ending) for r in rules.collect()} == want
    words = ["дгами", "ббая", "ы", "вгов", "zzz", "", None, "дгами", "пришли", "а" * 40 + "ами"]
    got = {r.token: r.lemma for r in lemmas.apply_rules(spark.createDataFrame([(w,) for w in words], "token string"), rules).collect()}
    guess = {}
    for w in filter(None, words):
        n = next((n for n in range(min(len(w), lemmas.LONGEST), 0, -1) if w[-n:] in want), 0)
        if n:
            _, cut, ending = want[w[-n:]]
            guess[w] = w[: len(w) - cut] + ending
    assert got == guess and "zzz" not in got
    df = spark.createDataFrame([(1, "дгами zzz пошли")], "k long, t string")
    every = lemmas.with_unknown(df, "t", table)
    assert mentions.lemmatise(df, "t", every, "n", rows=0).first().n == f"{guess['дгами']} zzz идти"


def test_lemmas_without_python_workers(spark):
    df = spark.createDataFrame([(1, "a b")], "k long, t string")
    table = spark.createDataFrame([("a", "z")], "token string, lemma string")
    for most in (256, 0):
        plan = mentions.lemmatise(df, "t", table, "n", rows=most)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "x double")
    assert [(r.bin, r["count"]) for r in explore.histogram(df, "x", 5).orderBy("bin").collect()] == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    flat = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [(r.bin, r["count"]) for r in explore.histogram(flat, "x", 5).collect()] == [(0, 2)]


def test_whole_text_across_any_position(spark):
    df = spark.range(995, 1006).select(F.lit(1).alias("k"), F.col("id").alias("p"), F.col("id").cast("string").alias("t"))
    (row,) = explore.reassemble(df.repartition(3), "k", "p", "t").collect()
    assert row.t == ".".join(map(str, range(995, 1006)))


def test_haversine_of_nan(spark):
    from venuemart.functions.geo import haversine

    df = spark.createDataFrame([(float("nan"), 1.0)], "a double, b double")
    assert math.isnan(df.select(haversine(F.col("a"), F.col("b"), F.col("b"), F.col("b")).alias("d")).first().d)


def test_token_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b", ""],), ([],), (None,)], "w array<string>")
    got = [r.c for r in df.select(mentions.token_counts(F.col("w")).alias("c")).collect()]
    assert [[tuple(x) for x in c or []] for c in got] == [[("", 1), ("a", 1), ("b", 2)], [], []]


def test_reassemble_in_parts(spark):
    df = spark.range(25).select(F.lit(1).alias("k"), F.col("id").alias("p"), F.col("id").cast("string").alias("t"))
    parts = [r.t for r in explore.reassemble(df.repartition(5), "k", "p", "t", chunk=10).orderBy("part").collect()]
    assert len(parts) == 3 and ".".join(parts) == ".".join(map(str, range(25)))
