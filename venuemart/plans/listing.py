"""Listing and detail pages to tables, and their match with the register."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuemart.functions.text import not_blank, sentences
from venuemart.functions.urls import resolve_link
from venuemart.operators.ids import checkpoint_sorted, first_per_key, number_rows
from venuemart.operators.match import match_listing
from venuemart.sources.pages import detail_rows, listing_rows

# The columns of the main listing table, in its order.
MAIN_COLUMNS = [
    "url", "dttm", "fname", "title", "rating", "cuisine", "phone", "city", "address", "x_coord", "y_coord",
    "avg_check", "opening_hours", "street_address", "street_locality", "global_id",
]


def listing_table(envelopes: DataFrame, site: str, strict: bool = True) -> DataFrame:
    """Listing rows with absolute links; of equal links the first by file and card position stays."""
    rows = listing_rows(envelopes, strict).withColumn("link", resolve_link(F.lit(site), F.col("link")))
    return first_per_key(rows, ["link"], [F.col("fname"), F.col("pos")]).drop("pos", "error")


def details_table(envelopes: DataFrame, strict_reference: bool = False) -> DataFrame:
    return detail_rows(envelopes, strict_reference)


def with_details(listing: DataFrame, details: DataFrame) -> DataFrame:
    """Listing rows joined to the details of their link, with the lower-case title.

    The listing's own url, dttm and fname give way to those of the details.
    """
    own = listing.drop("url", "dttm", "fname").withColumnRenamed("link", "url")
    joined = details.join(own, "url")
    return joined.withColumn("link", F.col("url")).withColumn("title_norm", F.lower("title"))


def matched_listing(listing: DataFrame, details: DataFrame, register: DataFrame, radius: float = 300.0) -> DataFrame:
    return match_listing(with_details(listing, details), register, radius)


def main_table(matched: DataFrame) -> DataFrame:
    return matched.select(*MAIN_COLUMNS)


def star_aspects(matched: DataFrame) -> DataFrame:
    """One row per venue and rated aspect: global_id, aspect_stars (the aspect), url, rating."""
    stars = F.from_json("aspect_stars", "map<string,int>")
    return matched.select("global_id", "url", F.explode(stars).alias("aspect_stars", "rating")).select(
        "global_id", "aspect_stars", "url", "rating"
    )


def split_sentences(df: DataFrame, text: str) -> DataFrame:
    """One row per sentence that is not blank, as written, with its `pos` among all parts of the text."""
    others = [c for c in df.columns if c != text]
    # The outer explode keeps Spark from splitting a text twice to see whether there is anything to explode.
    split = df.select(*others, F.posexplode_outer(sentences(F.col(text))).alias("pos", text))
    return split.where(not_blank(F.col(text))).select(*df.columns, "pos")


def review_sentences(matched: DataFrame, source: str) -> DataFrame:
    """Sentences of the reviews: global_id, review, url, source and a dense sentence_id.

    Ids follow (global_id, url, review, position), so they do not depend on the layout. Only whole reviews
    are sorted; sentences are split after it.
    """
    reviews = matched.where("review is not null").select("global_id", "review", "url")
    stored = checkpoint_sorted(reviews, [F.col("global_id"), F.col("url"), F.col("review")])
    numbered = number_rows(split_sentences(stored, "review"), "sentence_id")
    return numbered.select("global_id", "review", "url", F.lit(source).alias("source"), "sentence_id")


def listing_mart(listing: DataFrame, details: DataFrame, register: DataFrame, source: str, radius: float = 300.0):
    """The three tables of matched venues: main, star aspects, review sentences.

    The match is kept (memory, then disk) because all three read it; call `unpersist` on the fourth value
    when they are written.
    """
    matched = matched_listing(listing, details, register, radius).persist(StorageLevel.MEMORY_AND_DISK)
    return main_table(matched), star_aspects(matched), review_sentences(matched, source), matched
