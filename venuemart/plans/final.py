"""The final venue table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venuemart.operators.skew import skew_join

# The columns of the final table, in its order.
REGISTER_COLUMNS = ["global_id", "Name", "Address", "SeatsCount", "SocialPrivileges", "x_coord", "y_coord"]
LISTING_COLUMNS = ["url", "cuisine", "phone", "avg_check", "global_id", "opening_hours"]


def final_table(register: DataFrame, listing: DataFrame, ratings: DataFrame) -> DataFrame:
    """Register rows with a listing match, their listing fields and rating (0 if not rated)."""
    listing_fields = [c for c in LISTING_COLUMNS if c != "global_id"]
    rated = register.select(*REGISTER_COLUMNS).join(ratings.select("global_id", "rating"), "global_id", "left")
    rows = skew_join(listing.select(*LISTING_COLUMNS), rated, ["global_id"])
    return rows.select(*REGISTER_COLUMNS, *listing_fields, F.coalesce("rating", F.lit(0.0)).alias("rating"))
