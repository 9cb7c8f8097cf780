"""Register of venues: raw export to flat table to mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from venuemart import lexicons
from venuemart.functions.address import with_address_parts
from venuemart.functions.text import name_norm
from venuemart.operators.skew import with_group_values, with_values_of_groups
from venuemart.session import use_checkpoints


def flatten_register(raw: DataFrame) -> DataFrame:
    """One flat row per register record; ids inside `Cells` win over the outer ones."""
    inner = raw.schema["Cells"].dataType.names
    # All fields that the schema declares, but for those that are handled apart.
    cells = [c for c in inner if c not in ("global_id", "Number", "PublicPhone", "geoData")]

    def own(name: str) -> Column:
        return F.coalesce(f"Cells.{name}", name).alias(name) if name in inner else F.col(name)

    phones = F.transform("Cells.PublicPhone", lambda m: F.try_element_at(F.map_values(m), F.lit(1)))
    place = F.col("Cells.geoData.coordinates")
    return raw.select(
        own("global_id"),
        own("Number"),
        *[F.col(f"Cells.`{c}`").alias(c) for c in cells],
        phones.alias("PublicPhone"),
        F.try_element_at(place, F.lit(1)).alias("x_coord"),
        F.try_element_at(place, F.lit(2)).alias("y_coord"),
    )


def latest_versions(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows whose version is the highest of their key, ties kept; rows without key or version leave."""
    latest = with_group_values(df, [key], _latest=F.max(version))
    return latest.where(F.col(version) == F.col("_latest")).drop("_latest")


def phone_or_null(phone: Column, is_array: bool) -> Column:
    """NULL for the values that mean "no phone", as array or as its printed form."""
    if is_array:
        none = (F.size(phone) == 0) | (phone == F.array(F.lit(lexicons.NO_PHONE)))
    else:
        none = phone.isin("[]", f"['{lexicons.NO_PHONE}']")
    return F.when(~none, phone)


def register_mart(register: DataFrame, strict_reference: bool = False) -> DataFrame:
    """Latest version of each café, bar or restaurant, with address parts, normal name and group counts."""
    rows = latest_versions(register, "global_id", "Number").where(F.col("TypeObject").isin(lexicons.VENUE_TYPES))
    is_array = isinstance(register.schema["PublicPhone"].dataType, T.ArrayType)
    rows = rows.withColumn("PublicPhone", phone_or_null(F.col("PublicPhone"), is_array))
    rows = with_address_parts(rows).withColumn("Name_norm", name_norm(F.col("Name"), strict_reference))
    # Read three times below; stored once, so the address patterns run once.
    use_checkpoints(register.sparkSession)
    rows = rows.checkpoint()
    return with_values_of_groups(
        rows,
        {
            ("OperatingCompany",): {"OperatingCompany_count": F.count("Name")},
            ("Name_norm",): {"Name_norm_count": F.count("Name_norm")},
        },
    )
