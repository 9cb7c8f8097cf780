"""Extraction from saved pages: one Arrow-batched job per page table."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from venuemart import schemas
from venuemart.functions.urls import base_url, cache_key, hash256, resolve_link, strip_slashes
from venuemart.sources.html import Node, parse_html

STAR = "i-star orange"
#: Pages whose texts and fields a task holds at once, besides the batch they come in.
SLICE = 128
# Fixed value: the map call that holds a venue's latitude and longitude.
PLACEMARK = re.compile(r"Placemark\(\[(\d+\.\d+),\ (\d+.\d+)\]")


def extract_pages(
    df: DataFrame, parse: Callable[[Node], dict], schema: str, html: str = "html", url: str = "url", strict: bool = False
) -> DataFrame:
    """Run `parse(root)` once per page; its fields follow the columns of `df`, then `error`.

    A page that fails gives NULL fields and a message with parser, URL and cause; with `strict` the job fails.
    A NULL page gives NULL fields.
    """
    fields = T.StructType.fromDDL(schema)
    fields.add("error", T.StringType())
    kept = [f.name for f in df.schema.fields if f.name != html]
    out = T.StructType([*(df.schema[c] for c in kept), *fields.fields])
    kinds = {f.name: to_arrow_type(f.dataType) for f in fields.fields}
    name = getattr(parse, "__name__", "parser")

    def parse_one(link: str, page: str | None) -> dict:
        if page is None:
            return {}
        try:
            return parse(parse_html(page))
        except Exception as cause:
            message = f"{name} failed on link {link}: {cause}"
            if strict:
                raise ValueError(message) from cause
            return {"error": message}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, at in ((b, k) for b in batches for k in range(0, b.num_rows, SLICE)):
            batch = whole.slice(at, SLICE)
            rows = [parse_one(u, p) for u, p in zip(batch[url].to_pylist(), batch[html].to_pylist())]
            parsed = [pa.array([row.get(f) for row in rows], kind) for f, kind in kinds.items()]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *parsed], names=[*kept, *kinds])

    return df.mapInArrow(run, out)


# --- parsers of one page or card --------------------------------------------------------------------------
# Tag, class and attribute names below are those of the saved pages.


def _need(node: Node | None, what: str) -> Node:
    if node is None:
        raise ValueError(f"{what} not found")
    return node


def value_title(root: Node, cls: str, required: bool = False) -> str | None:
    """The `title` of the `value-title` span inside the span of a class."""
    outer = root.find("span", cls)
    inner = outer.find("span", "value-title") if outer else None
    if inner is None and required:
        raise ValueError(f"value of {cls} not found")
    return inner.attrs["title"] if inner else None


def parse_listing(root: Node) -> dict:
    """Cards of a listing page, upper list first."""
    lists = [root.find("ul", f"{name} clearfix") for name in ("l-restaurants", "l-restaurants-vertical")]
    return {"cards": [card.markup() for part in lists if part for card in part.find_all("span", "vcard")]}


def parse_pagination(root: Node) -> dict:
    """Links of the page list, as written."""
    box = root.find("div", "restaurants_rating clearfix")
    pages = box.find("ul", "l-links clearfix", deep=False) if box else None
    return {"links": [a.attrs["href"] for a in pages.find_all("a")] if pages else []}


def parse_card(root: Node) -> dict:
    """Fields of one listing card; a missing one is an error."""
    link = root.find("a", "permalink") or root.find("a", "clearfix")
    stars = root.find("span", "col col_2") or root.find("span", "stars")
    cuisine = root.find("span", "col col_3") or root.find("span", "cuisine")
    return {
        "title": _need(root.find("span", "fn org"), "title").text,
        "link": _need(link, "link").attrs["href"],
        "rating": len(_need(stars, "rating").find_all("i", STAR)),
        "cuisine": _need(cuisine, "cuisine").text,
        "phone": value_title(root, "tel", required=True),
        "city": value_title(root, "locality", required=True),
        "address": value_title(root, "street-address", required=True),
    }


def parse_detail(root: Node) -> dict:
    """Fields of a venue page. The map gives latitude first; x is the longitude."""
    found = None
    if box := root.find("div", "col col_img"):
        found = PLACEMARK.search(_need(box.find("script", type="text/javascript"), "map script").text)
    data = _need(root.find("div", "data"), "div with data")
    check = data.find("div", "row average_check")

    def meta(prop: str) -> str | None:
        node = data.find("meta", itemprop=prop)
        return node.attrs["content"] if node else None

    stats = root.find("div", "rest_stats")
    stars = None
    if stats:
        counts = [len(s.find_all("i", STAR)) for s in stats.find_all("div", "stars")]
        stars = dict(zip((t.text for t in stats.find_all("div", "title")), counts))
    review = root.find("div", "item-review-col_right")
    texts = [t.text.strip("\r\n\t ") for t in review.find_all("div", "data-text")] if review else None
    return {
        "x_coord": float(found.group(2)) if found else None,
        "y_coord": float(found.group(1)) if found else None,
        "avg_check": check.text if check else None,
        "opening_hours": meta("openingHours"),
        "street_address": meta("streetAddress"),
        "address_locality": meta("addressLocality"),
        "aspect_stars": None if stars is None else list(stars.items()),
        "review": None if texts is None else "\n".join(texts),
    }


# --- page tables ------------------------------------------------------------------------------------------


def listing_pages(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Cards and page links of listing pages (`url`, `html`)."""

    def listing(root: Node) -> dict:
        return {**parse_listing(root), **parse_pagination(root)}

    return extract_pages(pages, listing, "cards array<string>, links array<string>", strict=strict)


def next_link(links: Column, url: Column) -> Column:
    """The link after the first one that leads to the page itself; links resolve against the site."""
    full = F.transform(links, lambda link: resolve_link(base_url(url), link))
    at = F.array_position(F.transform(full, strip_slashes), strip_slashes(url))
    return F.when(at > 0, F.try_element_at(full, (at + 1).cast("int")))


def parse_cards(cards: DataFrame, card: str = "card", url: str = "url", strict: bool = False) -> DataFrame:
    return extract_pages(cards, parse_card, schemas.CARD, html=card, url=url, strict=strict)


def listing_rows(envelopes: DataFrame, strict: bool = True) -> DataFrame:
    """Listing rows of fetched pages that are `ok` (columns ok, url, dttm, fname, data.cards)."""
    cards = envelopes.where("ok").select("url", "dttm", "fname", F.posexplode("data.cards").alias("pos", "card"))
    rows = parse_cards(cards, strict=strict)
    return rows.select(*[f.name for f in T.StructType.fromDDL(schemas.LISTING).fields], "pos", "error")


def detail_pages(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Fields of venue pages (`url`, `html`)."""
    return extract_pages(pages, parse_detail, schemas.DETAIL_DATA, strict=strict)


def detail_rows(envelopes: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Detail rows of fetched pages that are `ok`, star map as JSON text.

    `street_locality` holds the address locality; with `strict_reference` it stays NULL, as the original
    column mismatch leaves it.
    """
    locality = F.lit(None).cast("string") if strict_reference else F.col("data.address_locality")
    return envelopes.where("ok").select(
        "url",
        "dttm",
        "fname",
        "data.x_coord",
        "data.y_coord",
        "data.avg_check",
        "data.opening_hours",
        "data.street_address",
        locality.alias("street_locality"),
        F.to_json("data.aspect_stars").alias("aspect_stars"),
        "data.review",
    )


def envelope(pages: DataFrame, data: str | None = None) -> DataFrame:
    """Fetch record of pages: given metadata columns, content hash, and `data` (empty unless ok).

    Metadata columns missing from `pages` are NULL.
    """
    meta = T.StructType.fromDDL(schemas.ENVELOPE)
    out = []
    for field in meta.fields:
        if field.name == "sha256":
            out.append(hash256(F.col("html")).alias("sha256"))
        elif field.name in pages.columns:
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
    if data:
        out.append(F.when(F.col("ok"), F.col(data)).alias("data"))
    return pages.select(*out)


# --- fetch frontier ---------------------------------------------------------------------------------------


def _with_key(df: DataFrame, url: str) -> DataFrame:
    return df.withColumn("key", cache_key(F.col(url)))


def frontier(links: DataFrame, cache: DataFrame, limit: int | None = None, link: str = "link", pos: str = "pos"):
    """Links still to be fetched: those without an `ok` cache entry, among the first `limit` by position."""
    wanted = links if limit is None else links.orderBy(pos, link).limit(limit)
    return _with_key(wanted, link).join(cache.where("ok").select("key"), "key", "left_anti").select(*links.columns, "key")


def cached(links: DataFrame, cache: DataFrame, link: str = "link") -> DataFrame:
    """Links whose page can be restored from an `ok` cache entry."""
    return _with_key(links, link).join(cache.where("ok").select("key"), "key", "left_semi").select(*links.columns, "key")
