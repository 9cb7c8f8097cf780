"""Page parsing, envelopes, frontier."""

import json

import pytest
from pyspark.sql import functions as F

from venuemart import schemas
from venuemart.catalog import pages as queries
from venuemart.functions.urls import cache_key
from venuemart.plans import listing
from venuemart.sources import files, pages
from venuemart.sources.html import parse_html

# Tags and class names are those of the saved pages; all values are made up here.
CARD = """<span class="vcard">
<a class="clearfix" href="place-17.html"><span class="col col_1"><span class="fn org">Ромашка</span></span>
<span class="col col_2"><i class="i-star orange"></i><i class="i-star"></i></span><span class="col col_3"><span>Пироги</span></span></a>
<span class="tel"><span class="value-title" title="+7 000 17"></span></span>
<span class="adr"><span class="locality"><span class="value-title" title="Тверь"></span></span>
<span class="street-address"><span class="value-title" title="ул. &quot;Садовая&quot;"></span></span></span>
<span class="empty"><b>no value</b></span></span>"""

PAGES = """<div class="restaurants_rating clearfix"><p><ul class="l-links clearfix"><a href="/no">x</a></ul></p>
<ul class="l-links clearfix"><li><a href="/restaurants/">1</a></li><li><a href="/restaurants/?curPos=7">2</a></li></ul></div>"""


def test_tree_keeps_unclosed_tags_and_entities():
    root = parse_html("<div class='a b'><p><b>one<br><p>two &amp; three</div><script>var t='</p>';</script><i>end")
    assert root.find("div", "a").text == "onetwo & three"
    assert root.find("div", "a b") is root.find("div", "b") is not None
    assert root.find("div", "b a") is None
    assert root.find("script").text == "var t='</p>';"
    assert root.find("i").text == "end"
    again = parse_html(root.markup())
    assert again.text == root.text and again.markup() == root.markup()


def test_value_title():
    root = parse_html(CARD)
    assert pages.value_title(root, "tel") == "+7 000 17"
    assert pages.value_title(root, "none") is None and pages.value_title(root, "empty") is None
    for name in ("none", "empty"):
        with pytest.raises(ValueError):
            pages.value_title(root, name, required=True)


def test_card_fields_and_errors(spark):
    broken = CARD.replace('"locality"', '"loc"')
    df = spark.createDataFrame([("u1", CARD), ("u2", broken), ("u3", None)], "url string, card string")
    good, bad, none = pages.parse_cards(df).orderBy("url").collect()
    assert good.title == "Ромашка" and good.rating == 1 and good.cuisine == "Пироги" and good.link == "place-17.html"
    assert good.address == 'ул. "Садовая"' and good.city == "Тверь" and good.phone == "+7 000 17" and good.error is None
    assert bad.title is None and "u2" in bad.error and "parse_card" in bad.error and "locality" in bad.error
    assert none.title is None and none.error is None
    with pytest.raises(Exception, match="u2"):
        pages.parse_cards(df, strict=True).collect()


def test_listing_page_order(spark):
    cards = [CARD.replace("Ромашка", n) for n in "абв"]
    html = f'<ul class="l-restaurants-vertical clearfix">{cards[2]}</ul><ul class="l-restaurants clearfix">{cards[0]}{cards[1]}</ul>'
    found = pages.listing_pages(spark.createDataFrame([("u", html), ("v", "<p>")], "url string, html string")).orderBy("url").collect()
    assert ["".join(n for n in "абв" if f">{n}<" in c) for c in found[0].cards] == ["а", "б", "в"]
    assert found[1].cards == [] and found[1].links == []


@pytest.mark.parametrize("url, after", [("https://food.example.net/restaurants/", True), ("https://food.example.net/restaurants", True), ("https://food.example.net/restaurants/?curPos=7", False), ("https://food.example.net/x", False)])
def test_next_link(spark, url, after):
    df = pages.listing_pages(spark.createDataFrame([(url, PAGES)], "url string, html string"))
    got = df.select(pages.next_link(F.col("links"), F.col("url")).alias("n")).first().n
    assert got == ("https://food.example.net/restaurants/?curPos=7" if after else None)


def write_json(folder, name, value):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(value), encoding="utf-8")


def envelope(ok, data, url="https://venues.example.org/p"):
    return {"ok": ok, "elapsed": 0.25, "status_code": 203, "reason": "Fine", "url": url, "encoding": "koi8-r", "headers": {"server": "s1"}, "dttm": "2031-02-03 04:05:06", "sha256": "c0ffee", "data": data}


def test_listing_files(spark, tmp_path):
    folder = tmp_path / "pages"
    write_json(folder, "b.json", envelope(True, {"cards": [CARD.replace("Ромашка", "Василёк"), CARD.replace("place-17", "place-18")], "next_link": None}))
    write_json(folder, "a.json", envelope(True, {"cards": [CARD], "next_link": "page-2"}))
    write_json(folder, "c.json", envelope(False, {}))
    read = files.with_file_name(files.read_json_folder(spark, str(folder), schemas.LISTING_ENVELOPE))
    got = listing.listing_table(read, "https://venues.example.org/").orderBy("link").collect()
    assert [(r.link, r.title, r.fname, r.rating) for r in got] == [
        ("https://venues.example.org/place-17.html", "Ромашка", "a.json", 1),
        ("https://venues.example.org/place-18.html", "Ромашка", "b.json", 1),
    ]


def test_detail_files(spark, tmp_path):
    folder = tmp_path / "details"
    data = {"x_coord": 35.9, "y_coord": 56.8, "avg_check": "700", "opening_hours": "9-21", "street_address": "Садовая, 3", "address_locality": "Тверь", "aspect_stars": {"Пироги": 4}, "review": "Пышные."}
    write_json(folder, "a.json", envelope(True, data, "food.example.net/17"))
    write_json(folder, "b.json", envelope(True, {**data, "aspect_stars": None}, "food.example.net/18"))
    write_json(folder, "c.json", envelope(False, {}))
    read = files.with_file_name(files.read_json_folder(spark, str(folder), schemas.DETAIL_ENVELOPE))
    first, second = listing.details_table(read).orderBy("fname").collect()
    assert (first.url, first.fname, first.x_coord, first.street_locality) == ("food.example.net/17", "a.json", 35.9, "Тверь")
    assert json.loads(first.aspect_stars) == {"Пироги": 4} and second.aspect_stars is None
    assert listing.details_table(read, strict_reference=True).where("street_locality is not null").count() == 0


DETAIL = """<div class="col col_img"><script type="text/javascript">new ymaps.Placemark([55.75, 37.61], {});</script></div>
<div class="data"><div class="row average_check">1000 руб</div><meta itemprop="openingHours" content="10-22"></div>
<div class="rest_stats"><div class="title">Еда</div><div class="stars"><i class="i-star orange"></i></div><div class="title">Цена</div></div>
<div class="item-review-col_right"><div class="data-text">\r\n Раз. \t</div><div class="data-text">Два</div></div>"""


def test_detail_page(spark):
    html = [("a", DETAIL), ("b", '<div class="data"></div>'), ("c", "<p>"), ("d", '<div class="col col_img"></div><div class="data"></div>')]
    a, b, c, d = pages.detail_pages(spark.createDataFrame(html, "url string, html string")).orderBy("url").collect()
    assert (a.x_coord, a.y_coord, a.avg_check, a.opening_hours, a.street_address) == (37.61, 55.75, "1000 руб", "10-22", None)
    assert a.aspect_stars == {"Еда": 1} and a.review == "Раз.\nДва"
    assert b.aspect_stars is None and b.review is None and b.x_coord is None and b.error is None
    assert "data" in c.error and "script" in d.error


def test_user_parser(spark):
    df = spark.createDataFrame([(2**60 + 1, "u", "<h1>x</h1>"), (None, "v", "<h1>y</h1>")], "id long, url string, html string")
    got = pages.extract_pages(df, lambda root: {"h": root.find("h1").text}, "h string").orderBy("url").collect()
    assert [(r.id, r.h) for r in got] == [(2**60 + 1, "x"), (None, "y")]


def test_frontier(spark):
    links = spark.createDataFrame([(i, f"https://a.org/{i}") for i in range(6)], "pos int, link string")
    cache = links.where("pos < 4").select(cache_key(F.col("link")).alias("key"), (F.col("pos") % 2 == 0).alias("ok"))
    cache = cache.unionAll(cache)
    assert sorted(r.pos for r in pages.frontier(links, cache).collect()) == [1, 3, 4, 5]
    assert sorted(r.pos for r in pages.frontier(links, cache, limit=4).collect()) == [1, 3]
    assert sorted(r.pos for r in pages.cached(links, cache).collect()) == [0, 2]


def test_pages_are_parsed_in_slices(spark, monkeypatch):
    """A task holds the texts and fields of few pages at once, however large the batch is."""
    monkeypatch.setattr(pages, "SLICE", 3)
    df = spark.createDataFrame([(f"u{i}", f"<h1>{i}</h1>") for i in range(10)], "url string, html string").coalesce(1)
    sizes = []
    frame = type(df)
    monkeypatch.setattr(frame, "mapInArrow", lambda self, run, schema: sizes.extend(b.num_rows for b in run([df.toArrow().combine_chunks().to_batches()[0]])) or self)
    pages.extract_pages(df, lambda root: {"h": root.find("h1").text}, "h string")
    assert sizes == [3, 3, 3, 1]


def test_small_tables_of_costly_rows_are_spread(spark, tmp_path):
    """Cards and venue pages are parsed by all cores, also if the table is one file."""
    rows = [(i, f"name {i}", i % 25, "BUILDING", 1.5 * i) for i in range(40)]
    df = spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double")
    df.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    for made in (queries.card_fields, queries.detail_fields):
        assert made(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r.title for r in queries.card_fields(spark, str(tmp_path)).collect()) == sorted(r[1] for r in rows)
