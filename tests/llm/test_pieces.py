"""Encoding against the library in unigram mode, decoding against exact round trips."""

import hashlib
import random

import pytest

from venuemart.llm import pieces

FILE = pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load(FILE)


def unigram(drop_wide=True):
    """The same pieces, read by the library as a unigram model: field 3 of the trainer's settings is the kind."""
    import sentencepiece

    raw = open(FILE, "rb").read()
    out, at = bytearray(), 0

    def varint(data, at):
        value = shift = 0
        while True:
            b = data[at]
            value |= (b & 127) << shift
            at, shift = at + 1, shift + 7
            if b < 128:
                return value, at

    def coded(n):
        made = bytearray()
        while n > 127:
            made.append(n & 127 | 128)
            n >>= 7
        return bytes([*made, n])

    while at < len(raw):
        tag, start = varint(raw, at)
        size, body = varint(raw, start)
        part = raw[body : body + size]
        if tag == 0x12:
            kept, k = bytearray(), 0
            while k < len(part):
                field, after = varint(part, k)
                if field & 7 == 2:
                    n, after = varint(part, after)
                    after += n
                elif field & 7 == 5:
                    after += 4
                else:
                    _, after = varint(part, after)
                if field >> 3 != 3:
                    kept += part[k:after]
                k = after
            part = bytes(kept) + b"\x18\x01"
        out += coded(tag) + coded(len(part)) + part
        at = body + size
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(out))


def texts():
    rng = random.Random(4)
    words = ["the", "eringble", "Ertion,", "schüng", "é", "naïve", "foo_bar", "12345", "the.", "ciónmente", "a", "***", "==", "日本", "ℝ"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(60)] + ["a\nb c\n\nd", "x  y", "tab\there", " lead", "trail "]


def test_encoding_is_the_best_path(vocabulary):
    library = unigram()
    for t in texts():
        mine = vocabulary.encode(t)
        total = lambda ids: sum(vocabulary.scores[i] for i in ids)
        # Byte pieces score nothing; characters written as bytes are the same in all. The library adds up in
        # single precision, so its path may be the worse one.
        for theirs in (library.encode(t), library.nbest_encode(t, nbest_size=1)[0]):
            assert mine == theirs or total(mine) >= total(theirs), t
            assert vocabulary.decode(mine) == t == library.decode(theirs)


def test_best_path_by_brute_force():
    made = [("<unk>", 0, "unknown"), ("a", -1.0, "normal"), ("ab", -2.5, "normal"), ("b", -1.2, "normal"), ("abc", -2.0, "normal"), ("▁", -0.5, "normal"), ("▁a", -3.0, "normal"), ("bc", -0.1, "normal")]
    own = pieces.Vocabulary(made)
    score = {p: s for p, s, kind in made if kind == "normal"}

    def best(t):
        if not t:
            return 0.0
        got = [score[t[:k]] + best(t[k:]) for k in range(1, len(t) + 1) if t[:k] in score]
        return max(got + [own.least + best(t[1:])] if t[0] not in score else got)

    rng = random.Random(8)
    for _ in range(200):
        t = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 9)))
        ids = own.encode(t)
        if 0 not in ids:
            assert abs(sum(made[i][1] for i in ids) - best("▁" + t.replace(" ", "▁"))) < 1e-9


def test_many_at_once_as_one_by_one(vocabulary):
    rng = random.Random(11)
    odd = ["日本", "ℝ", "a" * 30, "x", "\U0001f600", "é###", "''", "<0x0A>"]
    made = [" ".join(rng.choice([*odd, "".join(rng.choices("abcdeionthr.,é", k=rng.randint(1, 12)))]) for _ in range(50)) for _ in range(40)]
    made += ["", " ", "a\n\nb ", "▁x ▁▁"]
    one = pieces.load(FILE)
    vocabulary.known.clear()
    vocabulary.prepare(made)
    assert [vocabulary.encode(t) for t in made] == [one.encode(t) for t in made]
    # Cuts between characters that no piece joins leave the best path as it is.
    for t in made:
        for w in t.split():
            assert sum((one.segment(x) for x in one._parts("▁" + w)), ()) == one.segment("▁" + w)


def test_trie_holds_its_keys():
    rng = random.Random(6)
    keys = sorted({bytes(rng.choices(range(256), k=rng.randint(1, 4))) for _ in range(3000)})
    trie = pieces.DoubleArray(keys, list(range(len(keys))))
    for k, key in enumerate(keys):
        assert (len(key), k) in trie.prefixes(key, 0)
        found = [key[:end] for end, _ in trie.prefixes(key + b"zz", 0)]
        assert found == [p for p in (( key + b"zz")[:n] for n in range(1, len(key) + 3)) if p in set(keys)]


def test_round_trip_of_tables(spark, vocabulary):
    rows = [(1, "a b", "x", "y"), (2, None, None, None), (3, "", "", ""), (3, "", "", ""), (4, "w\u0000\U0001f600 é" * 20_000, "q", "r"), (None, "  \n ", "q", "r")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids string, row string")
    coded = pieces.encode(docs, vocabulary)
    out = pieces.decode(coded, vocabulary).select("row.row.*", "decoded").collect()
    assert [r.decoded for r in out] == [r[1] or "" for r in rows]
    assert pieces.encode(docs.limit(0), vocabulary).collect() == []
    assert pieces.decode(coded.limit(0), vocabulary).collect() == []
    both = pieces.encode_and_decode(docs, vocabulary).collect()
    for r, (i, text, *_) in zip(both, rows, strict=True):
        assert (r.doc_id, r.ids, r.n_ids) == (i, vocabulary.encode(text or ""), len(r.ids))
        assert r.exact and r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert pieces.encode_and_decode(docs.limit(0), vocabulary).collect() == []
