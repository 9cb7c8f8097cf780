"""Column functions: text, address, distance, links, scores."""

import math
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from venuemart import lexicons
from venuemart.functions import geo, scores, text, urls
from venuemart.functions.address import with_address_parts


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Мама готовила рыбу 55555 раз", "мама готовила рыбу раз"),
        ("Люблю грозу! она прекрасна, и что? ??", "люблю грозу она прекрасна и что"),
        ("a,b", "ab"),
        ("  \t\n ", ""),
        ("a b\x1cc — «d»", "a b c d"),
        (None, None),
    ],
)
def test_clean_text(spark, raw, clean):
    assert one(spark, text.clean_text, raw) == clean


def test_tokens_are_those_of_str_split(spark):
    for raw in ("", "  ", "a  b\tc\n", " x\x1fy"):
        assert one(spark, text.tokens, raw) == raw.split()
    assert one(spark, text.tokens, None) is None


@pytest.mark.parametrize(
    "name, norm",
    [
        ("Ресторан «Чебуречная»", "чебуречная"),
        ("Кафе Пушкин", "пушкин"),
        ("ExtraVirgin", "extra virgin"),
        ("ресторан ", "ресторан "),
        ("«»", ""),
        ("", None),
        (None, None),
    ],
)
def test_name_norm(spark, name, norm):
    assert one(spark, text.name_norm, name) == norm


def test_name_norm_strict_leaves_typos(spark):
    assert one(spark, lambda c: text.name_norm(c, strict_reference=True), "ExtraVirgin") == "extravirgin"


@pytest.mark.parametrize(
    "address, parts",
    [
        ("Улица пушкина, дом колотушкина, корпус пичужкина", ("улица", "пушкина", "дом", "колотушкина", "корпус", "пичужкина")),
        ("переулок пушкина, стр пичужкина", ("переулок", "пушкина", None, None, "строение", "пичужкина")),
        ("караул пушкина, выпад 7, атас пичужкина", (None,) * 6),
        ("ул пушкина, д 7, с пичужкина", ("улица", "пушкина", "дом", "7", "строение", "пичужкина")),
        ("город Москва, Сиреневый бульвар, дом 15А", ("бульвар", "сиреневый", "дом", "15а", None, None)),
        ("аул мира, ул. Ленина", ("улица", "ленина", None, None, None, None)),
        ("пр. Мира", ("проспект", "мира", None, None, None, None)),
        (None, (None,) * 6),
        ("", (None,) * 6),
    ],
)
def test_address_parts(spark, address, parts):
    df = with_address_parts(spark.createDataFrame([(address,)], "Address string"))
    assert tuple(df.first())[1:] == parts


def test_haversine(spark):
    df = spark.createDataFrame([(37.6, 55.73, 47.5, 42.98), (37.6, 55.73, 37.6, 55.73), (0.0, 0.0, 180.0, 0.0)], "a double, b double, c double, d double")
    far, same, opposite = (r[0] for r in df.select(geo.haversine(*map(F.col, "abcd"))).collect())
    assert 1.5e5 < far < 1.6e6
    assert same < 1e-5
    assert opposite == pytest.approx(math.pi * lexicons.EARTH_RADIUS)


def test_resolve_link_like_urljoin(spark):
    bases = ["https://a.example.org/x/y/z.html?q=1#f", "http://a.example.org", "https://a.example.org/restaurants/"]
    links = ["/p", "p", "../p", "./p", "../../../p/./q", "?curPos=7", "#top", "", "//b.example.org/p", "https://c.example.org/", "..", "a/../b"]
    pairs = [(b, k) for b in bases for k in links]
    df = spark.createDataFrame(pairs, "b string, k string")
    for row in df.select("b", "k", urls.resolve_link(F.col("b"), F.col("k")).alias("r")).collect():
        assert row.r == urljoin(row.b, row.k), (row.b, row.k)


def test_base_url_and_keys(spark):
    assert one(spark, urls.base_url, "https://somewebsite.org/page1/page2") == "https://somewebsite.org"
    assert one(spark, urls.base_url, "no url at all") is None
    assert one(spark, urls.cache_key, "a") == "chunk_ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb.json"


def test_polarity(spark):
    df = spark.createDataFrame([(0.1, 0.9, 0.0, 0.0, 0.0), (None, 0.9, 0.0, 0.0, 0.0), (900.0, 1000.0, 0.0, 0.0, 0.0)], ", ".join(f"{n} double" for n in lexicons.SCORE_LABELS))
    usual, missing, large = (r[0] for r in df.select(scores.polarity()).collect())
    total = math.exp(0.1) + math.exp(0.9) + 3
    assert usual == pytest.approx((math.exp(0.9) - math.exp(0.1)) / total)
    assert missing is None
    assert large == pytest.approx(1.0)


def test_top_labels(spark):
    df = spark.createDataFrame([(0.2, 0.7, 0.7)], "a double, c double, b double")
    best = df.select(scores.top_labels(["a", "c", "b"], 2).alias("r")).first()["r"]
    assert [(p.label, p.score) for p in best] == [("b", 0.7), ("c", 0.7)]
