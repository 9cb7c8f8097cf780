"""Exact, line and near dedup against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from venuemart.llm import components, exact_dedup, line_dedup, mphf, simhash
from venuemart.operators import skew

DOCS = "doc_id bigint, text string, row string, fp int, digest string, k1 int"


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 5000):
        a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
        slots = mphf.Slots(*mphf.build(a, b))
        assert sorted(slots.find(a, b).tolist()) == list(range(n))
        other = slots.find(b, a)
        assert ((other >= -1) & (other < max(n, 1))).all()


def test_hash_refuses_repeated_keys():
    with pytest.raises(ValueError):
        mphf.build(np.array([7, 7], np.uint64), np.array([1, 1], np.uint64))


def frame(spark, texts):
    rows = [(i, t, "r", 1, "d", 2) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


TEXTS = ["a b", "a  b", "a\tb ", "a b ", "", None, " ", "x\ny", "x y", "A b", "long " * 50_000, "long " * 50_000, "é ü", "é ü"]


def exact_truth(texts):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts]
    sizes = Counter(norm)
    keep = {}
    for (i, _), x in sorted(zip(texts, norm), key=lambda y: (y[0][0] is None, y[0][0] or 0)):
        keep.setdefault(x, i)
    return sorted(((i, keep[x], sizes[x], hashlib.sha256(x.encode()).hexdigest()) for (i, _), x in zip(texts, norm)), key=repr)


@pytest.mark.parametrize("cut", [-1, 6, 100])
def test_exact_dedup(spark, cut):
    texts = [*enumerate(TEXTS), (None, "a b"), (None, "only"), (3, "a b ")]
    out = exact_dedup.exact_dedup(frame(spark, texts), F.col("doc_id") <= cut).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out), key=repr) == exact_truth(texts)
    assert sum(r.kept for r in out) == len({r.text_sha256 for r in out})
    assert all(r.doc_id == r.keep_id for r in out if r.kept)


def test_exact_dedup_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD", 5)
    texts = [(i, f"t{i % 37}") for i in range(200)]
    out = exact_dedup.exact_dedup(frame(spark, texts), F.col("doc_id") < 90)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in out.collect()), key=repr) == exact_truth(texts)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(frame(spark, []), F.lit(True)).collect() == []


def lines_truth(texts, min_docs, min_chars=1):
    key = lambda x: x.encode().strip().lower().decode()
    n = Counter(k for _, t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or n[key(x)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("common", "shard"), [(20_000, 500_000), (10, 30), (1, 1000)])
def test_line_dedup(spark, common, shard):
    rng = random.Random(5)
    pool = ["Top", " top\t", "TOP", "", " ", "Äb", "äb", *[f"line {k}" for k in range(30)]]
    texts = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for k in range(60)]
    texts += [(60, None), (61, ""), (None, "Top\nonly here"), (5, texts[5][1]), (62, "Top\n" * 30_000), (63, "\n\n")]
    for chars in (1, 4):
        out = line_dedup.drop_lines(frame(spark, texts), 4, chars, common=common, shard=shard)
        got = [(r.row.doc_id, r.n_lines, r.n_dropped, r.kept) for r in out.collect()]
        assert sorted(got, key=repr) == lines_truth(texts, 4, chars)


def test_only_repeated_lines_are_indexed(spark):
    texts = [(k, f"shared {k % 4}\nown {k}") for k in range(40)]
    base = frame(spark, texts).select("text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    sent, verdicts, _ = line_dedup.repeated_lines(base, 10)
    assert verdicts is None and len(line_dedup.Lines(*sent.value).counts) == 4
    sent, verdicts, _ = line_dedup.repeated_lines(base, 10, common=7)
    assert len(line_dedup.Lines(*sent.value).counts) == 0 and verdicts.count() == 40


def test_line_dedup_of_nothing(spark):
    assert line_dedup.drop_lines(frame(spark, [])).collect() == []


def brute_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids_fps):
    at = list(range(len(ids_fps)))
    find = lambda x: x if at[x] == x else find(at[x])
    for i in range(len(at)):
        for j in range(i):
            if (ids_fps[i][1] ^ ids_fps[j][1]).bit_count() <= 2:
                at[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(ids_fps):
        least.setdefault(find(i), []).append(d)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(at))]


def test_simhash(spark):
    rng = random.Random(1)
    base = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(300)]
    texts = [(k, t) for k, t in enumerate(TEXTS)]
    for k in range(40):
        words = list(base)
        words[rng.randrange(300)] = "changed"
        texts.append((100 + k, " ".join(words)))
    texts += [(None, "a b"), (100, texts[-1][1]), (None, "alone here at last")]
    out = simhash.simhash_dedup(frame(spark, texts)).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in texts]
    want = sorted(((i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps))), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out), key=repr) == want


def test_fingerprint_in_chunks(monkeypatch):
    text = " ".join(str(i * i % 97) for i in range(1000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("longest", [1, 3, 32])
def test_links_join_what_is_near(spark, longest):
    rng = random.Random(longest)
    fps = set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(60):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(50)} | {0, 1, 3, 2**64 - 1, 2**63}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    rows = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    links = simhash.links(rows, longest)
    assert all(((r.u ^ r.v) % 2**64).bit_count() <= 2 for r in links.collect())
    found = {r.node: r.root for r in components.components(links).collect()}
    want = brute_components([(x, x % 2**64) for x in signed])
    assert [found.get(x, x) for x in signed] == want


def test_the_tally_rejects_pairs_before_they_are_verified(spark):
    # Bytes 0 to 3 in common, then as many of the others as named; all differences are of one bit.
    apart = [[], [4], [4, 5], [4, 5, 6], [4, 5, 6, 7]]
    fps = [0x0102030405060708 ^ sum(1 << (8 * p) for p in at) for at in apart]
    key = 0x0102030405060708 & 0xFFFFFFFF
    lists = spark.createDataFrame([(key, f) for f in fps], "key bigint, fp bigint")
    shared = lambda x, y: sum((x ^ y) >> (8 * p) & 255 == 0 for p in range(8))
    pairs = [(x, y) for x in fps for y in fps if x > y]
    got = {(r.u, r.v) for r in simhash.tallied(lists, simhash.PAIRED).collect()}
    assert got == {p for p in pairs if shared(*p) >= 6} and 0 < len(got) < len(pairs)
    assert {(r.u, r.v) for r in simhash.verified(simhash.tallied(lists, simhash.PAIRED), 1).collect()} == {
        (x, y) for x, y in got if (x ^ y).bit_count() <= 1
    }


def test_a_third_of_all_rows_in_one_text(spark, monkeypatch):
    monkeypatch.setattr(skew.skew_join, "__defaults__", ("inner", None, 5, None))
    texts = [(i, "a b c d" if i % 3 == 0 else f"w{i % 20} x{i} y z") for i in range(90)]
    out = simhash.simhash_dedup(frame(spark, texts)).collect()
    fps = [(i, brute_fingerprint(t)) for i, t in texts]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in out) == sorted(
        (i, f"{f:016x}", c) for (i, f), c in zip(fps, brute_components(fps))
    )


def test_components_of_a_chain(spark):
    pairs = [(i, i + 1) for i in range(100)] + [(200, 201), (300, 300)]
    out = {r.node: r.root for r in components.components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()}
    assert out == {**{i: 0 for i in range(101)}, 200: 200, 201: 200}


def test_one_per_group(spark):
    texts = [(3, "one two three four"), (1, "one two three four"), (1, "one two three four"), (2, ""), (5, None), (None, "z z z")]
    out = simhash.one_per_group(frame(spark, texts))
    assert out.columns == frame(spark, []).columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(1, "one two three four"), (2, ""), (None, "z z z")], key=repr)


def test_simhash_of_nothing(spark):
    assert simhash.simhash_dedup(frame(spark, [])).collect() == []


@pytest.mark.parametrize("old", [[], [0, 3], [1, 4], [0, 1, 2, 3, 4, 5, 6]])
def test_exact_dedup_of_large_ids_and_nulls(spark, old):
    """Whole numbers beyond 2^53 beside null ids, in the history, among the others, and in both."""
    big = 2**60
    rows = [(big + 3, "a  b"), (big + 1, "a b"), (None, "a b"), (None, "a b"), (big + 5, "c"), (None, "d"), (-big - 1, None)]
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "n int, doc_id bigint, text string")
    got = exact_dedup.exact_dedup(df, F.col("n").isin(old) if old else F.lit(False)).collect()
    kept = sorted(((r.doc_id, r.keep_id, r.group_size) for r in got if r.kept), key=repr)
    assert kept == sorted([(big + 1, big + 1, 4), (big + 5, big + 5, 1), (None, None, 1), (-big - 1, -big - 1, 1)], key=repr)
    assert {(r.doc_id, r.keep_id) for r in got} == {(big + 3, big + 1), (big + 1, big + 1), (None, big + 1), (big + 5, big + 5), (None, None), (-big - 1, -big - 1)}
