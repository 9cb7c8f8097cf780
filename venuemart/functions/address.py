"""Street, house and building taken from a comma-separated postal address."""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuemart import lexicons
from venuemart.functions.text import utrim

_SEP = "\x01"


def _stem(regex: str) -> str:
    """What every spelling of the pattern's keyword starts with: a part without it cannot match."""
    spellings = re.search(r"\(\?:([^)]*)\)", regex.replace(r"(?<!\w)", "")).group(1).replace("\\.", ".")
    return os.path.commonprefix(spellings.split("|"))


def address_part(address: Column, patterns: list[tuple[str, str]]) -> Column:
    """`struct(Type, Name)` of the first part that any pattern matches; patterns are tried in order."""

    def first_hit(part: Column) -> Column:
        # Group 1 is never empty, so an empty extract means "no match"; coalesce stops at the first hit. The
        # substring test spares most of the patterns.
        tries = []
        for regex, kind in patterns:
            name = F.nullif(F.regexp_extract(part, "(?sU)" + regex, 1), F.lit(""))
            tries.append(F.when(part.contains(_stem(regex)), F.concat(F.lit(kind + _SEP), name)))
        return F.coalesce(*tries)

    hits = F.filter(F.transform(F.split(F.lower(address), ","), first_hit), lambda h: h.isNotNull())
    hit = F.split(F.try_element_at(hits, F.lit(1)), _SEP, 2)
    return F.struct(hit[0].alias("Type"), utrim(hit[1]).alias("Name"))


def with_address_parts(df: DataFrame, address: str = "Address") -> DataFrame:
    """Add StreetType/Name, HouseType/Name and BuildingType/Name."""
    parts = {
        "Street": lexicons.STREET_PATTERNS,
        "House": lexicons.HOUSE_PATTERNS,
        "Building": lexicons.BUILDING_PATTERNS,
    }
    found = df.withColumns({f"_{p}": address_part(F.col(address), pats) for p, pats in parts.items()})
    flat = {f"{p}{f}": F.col(f"_{p}.{f}") for p in parts for f in ("Type", "Name")}
    return found.withColumns(flat).drop(*[f"_{p}" for p in parts])
