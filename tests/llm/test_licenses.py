"""License scans against plain search and full alignment."""

import os
import random

import numpy as np
import pytest

from venuemart.llm import licenses

HELD = licenses.prepare(licenses.TEMPLATES)


def full(template, text):
    """Best local score without a band."""
    best = 0
    above = [0] * (len(text) + 1)
    for word in template:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (1 if other == word else -1), above[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
        above = row
    return best


def test_banded_alignment_finds_the_best():
    rng = random.Random(2)
    for _ in range(100):
        template = [rng.randrange(6) for _ in range(rng.randint(1, 15))]
        text = [rng.randrange(6) for _ in range(5)] + [w for w in template if rng.random() > 0.1] + [rng.randrange(6) for _ in range(5)]
        matched, start, end = licenses.align(template, np.array(text), 5, 40)
        assert 0 <= start <= end <= len(text) and matched <= min(end - start, len(template))
        # Of a whole band the score is that of the full table; matches less other steps.
        assert matched >= full(template, text)


def test_winnowing_leaves_a_fingerprint_in_every_window():
    rng = random.Random(5)
    hashes = [rng.randrange(20) for _ in range(200)]
    chosen = licenses.winnow(hashes)
    assert all(any(k <= c < k + 3 for c in chosen) for k in range(198))


def test_exact_and_changed_templates():
    rng = random.Random(9)
    filler = lambda n: " ".join(f"zz{rng.randrange(999)}" for _ in range(n))
    for name, template in licenses.TEMPLATES.items():
        text = f"{filler(30)} É\n{template} {filler(30)}"
        found = licenses.scan(text, HELD)
        assert [f[0] for f in found] == [name] and found[0][1] == 1.0
        words = " ".join(template.split())
        assert licenses._tokens.findall(text[found[0][2] : found[0][3]]) == licenses._tokens.findall(words)
        if len(template.split()) > 30:
            changed = template.split()
            for k in range(7, len(changed), 15):
                changed[k] = "changed"
            changed.insert(20, "one two".split()[0])
            del changed[11]
            found = licenses.scan(filler(9) + " " + " ".join(changed) + " " + filler(9), HELD)
            assert [f[0] for f in found] == [name] and 0.8 <= found[0][1] < 1


def test_several_places_and_none():
    text = "Released under the MIT License. Some words here. Released under the MIT License."
    found = licenses.scan(text, HELD)
    assert [text[a:b] for _, _, a, b in found] == ["Released under the MIT License"] * 2
    assert licenses.scan("released under the same license as before", HELD) == []
    assert licenses.scan("", HELD) == []


def test_table(spark):
    long = "word " * 60_000 + "Licensed under CC BY-NC 4.0."
    rows = [(1, "Released under the MIT License.", "m", "r"), (2, None, None, None), (3, "", "m", "r"), (4, long, "m", "r"), (4, long, "m", "r"), (None, "x", "m", "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, matches string, row string")
    out = {r["row"]["doc_id"]: [(m["license"], m["coverage"]) for m in r["matches"]] for r in licenses.license_scan(docs).collect()}
    assert out == {1: [("MIT notice", 1.0)], 2: [], 3: [], 4: [("CC-BY-NC-4.0 notice", 1.0)], None: []}
    assert licenses.license_scan(docs.limit(0)).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_notices_in_documents(spark):
    """Every plain occurrence of a notice, by search."""
    short = {n: t.rstrip(".") for n, t in licenses.TEMPLATES.items() if n.endswith("notice")}
    for d in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        found = [(n, a) for n, _, a, _ in licenses.scan(d.text, HELD)]
        for n, t in short.items():
            at = d.text.find(t)
            while at >= 0:
                assert (n, at) in found
                at = d.text.find(t, at + 1)
