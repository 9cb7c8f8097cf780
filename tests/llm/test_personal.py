"""Personal data: the base against the plain patterns, the field against enumeration and held-out examples."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest

from venuemart.llm import personal, queries

SF = "/root/testdata/sf0.001"


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))) % 10 == 0


def brute_base(text):
    """The contract's patterns, as they are written there."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], personal.KINDS.index(s[0])))


def digest(base):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()


@pytest.fixture(scope="module")
def field():
    return personal.fit_field(personal.made_examples(random.Random(1), []))


def test_base_against_the_patterns(field):
    rng = random.Random(3)
    pieces = ["4111 1111 1111 1111", "378282246310005", "1.2.3.4", "300.1.2.3", "001.02.3.255", "+1 (521) 555-6210", "+49 30 1", "a@b.co", "x.y_%+-@q-r.s.t", "@", ".", "-", " ", "(", ")", "+", "[", "é", "\n", "٣", "at", "dot", *"0123456789", "12345678901234567890"]
    for _ in range(6000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 14)))
        base, added = field.spans(text)
        want = brute_base(text)
        assert sorted(((personal.KINDS[k], a, b) for a, b, k in base), key=lambda s: (s[1], personal.KINDS.index(s[0]))) == want, text
        covered = [set(range(a, b)) for a, b, _ in base + added]
        for a, b, _ in added:
            assert sum(bool(set(range(a, b)) & c) for c in covered) == 1, text


def enumerated(field, row):
    """The best total over all rows of segments."""
    n, best = len(row.starts), None
    arcs = {(i, j): [] for i in range(n) for j in range(i + 1, n + 1)}
    for i, j, label, score in row.arcs:
        arcs[i, j].append((label, score))
    for cuts in itertools.product([0, 1], repeat=n - 1):
        ends = [0, *[k + 1 for k, c in enumerate(cuts) if c], n]
        choices = [([(0, 0.0)] if b - a == 1 else []) + arcs[a, b] for a, b in itertools.pairwise(ends)]
        for labels in itertools.product(*choices):
            past, total = 0, 0.0
            for label, score in labels:
                total += field.pairs[past, label] + score
                past = label
            if best is None or total > best:
                best = total
    return best


def test_best_labelling_against_enumeration(field):
    rng = random.Random(4)
    weights = np.array([rng.gauss(0, 1) for _ in field.weights])
    for own in (field, personal.Field(field.names, weights)):
        seen = 0
        for text in ["12 345 6789 01", "4012(8888)888", "1[.]2[.]3[.]4 5", "a at b dot c", "x.y @ b . c dot d", "(212) 555-0199", "+555 01 998877"]:
            for row in personal.rows_of(text, None, own.score):
                if len(row.starts) > 11:
                    continue
                seen += 1
                chosen, past, at, total = own.best(row), 0, 0, 0.0
                for i, j, label in [*chosen, (len(row.starts), None, None)]:
                    while at < i:
                        total, past, at = total + own.pairs[past, 0], 0, at + 1
                    if label:
                        total += own.pairs[past, label] + max(s for a, b, k, s in row.arcs if (a, b, k) == (i, j, label))
                        past, at = label, j
                assert total == pytest.approx(enumerated(own, row))
        assert seen >= 5


def test_slope_of_the_likelihood():
    rng, names, rows = random.Random(5), {}, []
    for text, spans in [("call (212) 555-0199 12", [(5, 19, 3)]), ("a at b dot c dot d", [(0, 18, 0)]), ("12 34 567 8901", [])]:
        for row in personal.rows_of(text):
            arcs = [(i, j, k, np.array([names.setdefault(f"{k} {x}", 25 + len(names)) for x in f])) for i, j, k, f in row.arcs]
            gold = [a for a, (i, j, k, _) in enumerate(arcs) if (row.starts[i], row.ends[j - 1], k - 1) in spans]
            assert len(gold) == len(spans)
            rows.append((len(row.starts), arcs, gold))
    weights = np.array([rng.gauss(0, 0.5) for _ in range(25 + len(names))])
    _, slope = personal.likelihood(weights, rows, names)
    for k in rng.sample(range(len(weights)), 40):
        step = np.zeros_like(weights)
        step[k] = 1e-5
        rise = (personal.likelihood(weights + step, rows, names)[0] - personal.likelihood(weights - step, rows, names)[0]) / 2e-5
        assert slope[k] == pytest.approx(rise, abs=1e-5)


def test_held_out_examples(field):
    right = wrong = missed = 0
    for text, gold in personal.made_examples(random.Random(99), [], 100):
        base, added = field.spans(text)
        found = set(added) | (set(base) & set(gold))
        right, wrong, missed = right + len(found & set(gold)), wrong + len(found - set(gold)), missed + len(set(gold) - found)
    assert right / (right + wrong) > 0.97 and right / (right + missed) > 0.95


@pytest.mark.parametrize(
    "text, want",
    [
        ("please call (212) 555-0199 now", ["phone:12:26"]),
        ("write to jane.doe (at) uni-x (dot) ac (dot) uk today", ["email:9:46"]),
        ("host 10[.]0[.]0[.]1 is down", ["ip:5:19"]),
        ("from +1 (826) 555-4081 190.137.2.11 on", ["phone:5:22", "ip:23:35"]),
        ("number 8646308210557563 of 2019-2021", []),
        ("we met at noon. Dot com was over", []),
    ],
)
def test_other_writings(field, text, want):
    base, added = field.spans(text)
    assert personal._written(base + added) == ",".join(want)


@pytest.mark.parametrize("unit", ["1", "1 ", "12 34 ", "@", "a@", "a@b ", "(", "+1(", "a at b dot ", "dot ", "1.", "[.]1", "a.", "word "])
def test_long_texts_take_linear_time(field, unit):
    took = []
    for size in (20_000, 80_000):
        start = time.perf_counter()
        field.spans(unit * (size // len(unit)))
        took.append(time.perf_counter() - start)
    assert took[1] < 10 and took[1] < 12 * max(took[0], 0.02)


def test_rows_of_any_kind(spark, field):
    rows = [(1, "a@b.co +1 (521) 555-6210"), (1, "a@b.co +1 (521) 555-6210"), (None, "1.2.3.4"), (3, None), (4, ""), (5, "call (212) 555-0199 😀 1.2.3.4")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id bigint, text string, spans string, n_ip int")
    got = personal.find(df, field).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r.row.text or ""
        base = brute_base(text)
        assert r.base_sha256 == digest(base) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in personal.KINDS]
        assert r.row.spans == "x" and [f"{s.kind}:{s.start}:{s.end}" for s in r.found] == (r.spans.split(",") if r.spans else [])
        assert {(s.kind, s.start, s.end) for s in r.found if s.base} == set(base)


def test_empty_table_and_no_sample(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    field = personal.fit(docs, each=20)
    assert personal.find(docs, field).count() == 0
    assert field.spans("mail bob at example dot com please")[1]


def test_documents(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = queries.QUERIES["op11_personal_data"](spark, SF).collect()
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        base = brute_base(docs[r.doc_id])
        assert r.base_sha256 == digest(base)
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(","))
        assert not base or r.spans
