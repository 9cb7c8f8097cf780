"""Page, link and card queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venuemart.catalog import query, spread, table
from venuemart.catalog import sqltext as sql
from venuemart.catalog.venues import lat, lon
from venuemart.functions import urls
from venuemart.plans import listing
from venuemart.sources import pages

_UNESCAPED = "replace(replace({}, '&quot;', '\"'), '&amp;', '&')"


@query(
    f"SELECT page_id, url, {_UNESCAPED.format(chr(39).join(['regexp_extract(html, ', '(?s)<h1>(.*?)</h1>', ', 1)']))} AS heading, "
    f"{_UNESCAPED.format('''array_to_string(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1), ' ')''')} AS links, "
    "CAST(len(regexp_extract_all(html, '<p[> ]')) AS INTEGER) AS paragraphs, NULL::VARCHAR AS error FROM pages"
)
def page_extract(spark: SparkSession, sf: str) -> DataFrame:
    def outline(root) -> dict:
        return {
            "heading": root.find("h1").text,
            "links": " ".join(a.attrs["href"] for a in root.find_all("a")),
            "paragraphs": len(root.find_all("p")),
        }

    return pages.extract_pages(table(spark, sf, "pages"), outline, "heading string, links string, paragraphs int")


@query("SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS base FROM pages")
def base_url(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", urls.base_url(F.col("url")).alias("base"))


_LINKS = """SELECT page_id, url, CASE page_id % 8 WHEN 0 THEN '/a/b' WHEN 1 THEN 'https://other.example.org/x' WHEN 2 THEN '//cdn.example.org/y'
  WHEN 3 THEN '?page=3' WHEN 4 THEN 'leaf.html' WHEN 5 THEN '../up/./x' WHEN 6 THEN '#part' ELSE '' END AS link FROM pages"""


@query(
    f"""SELECT page_id, link, CASE page_id % 8 WHEN 0 THEN concat(base, '/a/b') WHEN 1 THEN link WHEN 2 THEN concat(scheme, ':', link)
  WHEN 3 THEN concat(base, path, link) WHEN 4 THEN concat(base, dir, link) WHEN 5 THEN concat(base, regexp_replace(dir, '[^/]*/$', ''),
  'up/x') WHEN 6 THEN concat(regexp_replace(url, '#.*$', ''), link) ELSE url END AS full FROM (SELECT *,
  regexp_extract(url, '^(https?://[^/]+)', 1) AS base, regexp_extract(url, '^(https?)', 1) AS scheme,
  regexp_extract(url, '^https?://[^/]+([^?#]*)', 1) AS path,
  regexp_extract(regexp_extract(url, '^https?://[^/]+([^?#]*)', 1), '^(.*/)', 1) AS dir FROM ({_LINKS}))"""
)
def resolve_links(spark: SparkSession, sf: str) -> DataFrame:
    kinds = ["/a/b", "https://other.example.org/x", "//cdn.example.org/y", "?page=3", "leaf.html", "../up/./x", "#part", ""]
    link = F.element_at(F.array(*[F.lit(k) for k in kinds]), (F.col("page_id") % 8 + 1).cast("int"))
    rows = table(spark, sf, "pages").select("page_id", "url", link.alias("link"))
    return rows.select("page_id", "link", urls.resolve_link(F.col("url"), F.col("link")).alias("full"))


@query(
    "SELECT page_id, CASE WHEN page_id % 5 < 4 THEN concat(base, '/', page_id % 5 + 1) END AS next_link FROM (SELECT page_id, "
    "regexp_extract(url, '^(https?://[^/]+)', 1) AS base FROM pages)"
)
def next_link(spark: SparkSession, sf: str) -> DataFrame:
    """Each page stands at one of the places /0 to /4 of a page list; the last has no next."""
    here = F.concat(urls.base_url(F.col("url")), F.lit("/"), F.col("page_id") % 5, F.lit("/"))
    rows = table(spark, sf, "pages").select("page_id", here.alias("url"))
    places = "".join(f'<li><a href="/{i}">{i}</a></li>' for i in range(5))
    html = F.lit(f'<div class="restaurants_rating clearfix"><ul class="l-links clearfix">{places}</ul></div>')
    found = pages.listing_pages(rows.withColumn("html", html))
    return found.select("page_id", pages.next_link(F.col("links"), F.col("url")).alias("next_link"))


def _card_html():
    """A listing card made from a customer row; the two layouts differ in their tags."""
    stars = F.repeat(F.lit('<i class="i-star orange"></i>'), (F.col("c_custkey") % 6).cast("int"))
    wide = F.concat(
        F.lit('<span class="vcard"><a class="clearfix" href="'), "link", F.lit('"><span class="col col_1"><span class="fn org">'),
        "c_name", F.lit('</span></span><span class="col col_2">'), stars, F.lit('</span><span class="col col_3"><span>'),
        "c_mktsegment", F.lit("</span></span></a>"),
    )
    tall = F.concat(
        F.lit('<span class="vcard"><a class="permalink" href="'), "link", F.lit('"></a><span class="fn org">'), "c_name",
        F.lit('</span><span class="stars"><i class="i-star"></i>'), stars, F.lit('</span><span class="cuisine">'), "c_mktsegment",
        F.lit("</span>"),
    )
    tail = F.concat(
        F.lit('<span class="tel"><span class="value-title" title="+7 '), "c_custkey",
        F.lit('"></span></span><span class="adr"><span class="locality"><span class="value-title" title="Москва &amp; область">'
              '</span></span><span class="street-address"><span class="value-title" title="ул. '), "c_nationkey",
        F.lit('"></span></span></span></span>'),
    )
    return F.concat(F.when(F.col("c_custkey") % 2 == 0, wide).otherwise(tall), tail)


def _cards(spark: SparkSession, sf: str) -> DataFrame:
    rows = spread(table(spark, sf, "customer")).withColumn("link", F.concat(F.lit("/r/"), "c_custkey"))
    return rows.select("c_custkey", F.concat(F.lit("p/"), F.floor(F.col("c_custkey") / 10)).alias("url"), _card_html().alias("card"))


_CARD_COLUMNS = """c_name AS title, CAST(c_custkey % 6 AS INTEGER) AS rating, c_mktsegment AS cuisine, concat('+7 ', c_custkey) AS phone,
  'Москва & область' AS city, concat('ул. ', c_nationkey) AS address"""


@query(f"SELECT c_custkey, {_CARD_COLUMNS}, concat('/r/', c_custkey) AS link, NULL::VARCHAR AS error FROM customer")
def card_fields(spark: SparkSession, sf: str) -> DataFrame:
    return pages.parse_cards(_cards(spark, sf)).drop("url")


@query(f"SELECT {_CARD_COLUMNS}, concat('https://venues.example.org/r/', c_custkey) AS link, concat('p/', c_custkey // 10) AS url, "
       "'2031-02-03 04:05:06' AS dttm, concat('chunk_', c_custkey // 10, '.json') AS fname FROM customer WHERE (c_custkey // 10) % 7 > 0")
def listing_table(spark: SparkSession, sf: str) -> DataFrame:
    """Whole listing pages: cards cut from the page, fields parsed, links resolved, duplicate links dropped."""
    cards = _cards(spark, sf)
    page = F.floor(F.col("c_custkey") / 10)
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "card"))), lambda c: c["card"]), "\n")
    saved = cards.groupBy(page.alias("page"), "url").agg(
        F.concat(F.lit('<ul class="l-restaurants clearfix">'), html, F.lit("</ul>")).alias("html")
    )
    # Small pages, costly to parse: spread over all cores rather than by size.
    cut = pages.listing_pages(saved.repartition(4 * spark.sparkContext.defaultParallelism, "url"), strict=True)
    envelope = cut.select(
        (F.col("page") % 7 > 0).alias("ok"), "url", F.lit("2031-02-03 04:05:06").alias("dttm"),
        F.concat(F.lit("chunk_"), "page", F.lit(".json")).alias("fname"), F.struct("cards").alias("data"),
    )
    twice = envelope.unionByName(envelope.withColumn("fname", F.concat(F.lit("later_"), "fname")))
    return listing.listing_table(twice, "https://venues.example.org/")


@query(
    f"""SELECT concat('d/', c_custkey) AS url, 'now' AS dttm, concat(c_custkey, '.json') AS fname,
  CASE WHEN c_custkey % 4 > 0 THEN round({sql.lon('c_custkey')}, 4) END AS x_coord,
  CASE WHEN c_custkey % 4 > 0 THEN round({sql.lat('c_custkey')}, 4) END AS y_coord,
  CASE WHEN c_custkey % 3 > 0 THEN concat(floor(c_acctbal)::BIGINT, ' руб') END AS avg_check, c_mktsegment AS opening_hours,
  concat('ул. ', c_nationkey) AS street_address, 'Москва' AS street_locality,
  CASE WHEN c_custkey % 5 > 0 THEN concat('{{"Еда":', c_custkey % 6, ',"Сервис":', c_custkey % 4, '}}') END AS aspect_stars,
  CASE WHEN c_custkey % 2 > 0 THEN concat(c_name, ' хорошо.', chr(10), 'Дорого. ', c_mktsegment) END AS review
  FROM customer WHERE c_custkey % 11 > 0"""
)
def detail_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Venue pages made from customers, parsed to the details table."""
    key = F.col("c_custkey")

    def star(n):
        return F.concat(F.lit('<div class="stars">'), F.repeat(F.lit('<i class="i-star orange"></i>'), n.cast("int")), F.lit("</div>"))

    def coord(c):
        return F.format_string("%.4f", c)

    place = F.concat(
        F.lit('<div class="col col_img"><script type="text/javascript">var p = new ymaps.Placemark(['), coord(lat("c_custkey")),
        F.lit(", "), coord(lon("c_custkey")), F.lit("], {a: '</div>'});</script></div>"),
    )
    check = F.concat(F.lit('<div class="row average_check">'), F.floor("c_acctbal"), F.lit(" руб</div>"))
    data = F.concat(
        F.lit('<div class="data">'), F.when(key % 3 > 0, check).otherwise(F.lit("")), F.lit('<meta itemprop="openingHours" content="'),
        "c_mktsegment", F.lit('"><meta itemprop="streetAddress" content="ул. '), "c_nationkey",
        F.lit('"/><meta itemprop="addressLocality" content="Москва"></div>'),
    )
    stats = F.concat(
        F.lit('<div class="rest_stats"><div class="title">Еда</div>'), star(key % 6), F.lit('<div class="title">Сервис</div>'),
        star(key % 4), F.lit('<div class="title">Цена</div></div>'),
    )
    review = F.concat(
        F.lit('<div class="item-review-col_right"><div class="data-text">\n '), "c_name",
        F.lit(' хорошо.\t</div><p><div class="data-text">Дорого. '), "c_mktsegment", F.lit("</div></div>"),
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body>"), F.when(key % 4 > 0, place).otherwise(F.lit("")), data,
        F.when(key % 5 > 0, stats).otherwise(F.lit("")), F.when(key % 2 > 0, review).otherwise(F.lit("")), F.lit("</body></html>"),
    )
    saved = spread(table(spark, sf, "customer")).select("c_custkey", F.concat(F.lit("d/"), "c_custkey").alias("url"), html.alias("html"))
    parsed = pages.detail_pages(saved, strict=True)
    fields = [f for f in parsed.columns if f not in ("c_custkey", "url", "error")]
    envelope = parsed.select(
        (key % 11 > 0).alias("ok"), "url", F.lit("now").alias("dttm"), F.concat(key, F.lit(".json")).alias("fname"),
        F.struct(*fields).alias("data"),
    )
    return listing.details_table(envelope)
