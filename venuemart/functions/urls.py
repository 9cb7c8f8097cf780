"""URL keys, base address and resolution of relative links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash256(c: Column) -> Column:
    return F.sha2(c, 256)


def cache_key(url: Column) -> Column:
    """File name under which the page of a URL is saved."""
    return F.concat(F.lit("chunk_"), hash256(url), F.lit(".json"))


def base_url(url: Column) -> Column:
    """Scheme and host."""
    return F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.try_parse_url(url, F.lit("AUTHORITY")))


def strip_slashes(url: Column) -> Column:
    return F.btrim(url, F.lit("/"))


def _collapse_dots(path: Column) -> Column:
    """Resolve `.` and `..` segments of an absolute path."""
    segments = F.slice(F.split(path, "/"), F.lit(2), F.size(F.split(path, "/")))
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))),
    )
    folder = F.regexp_like(path, F.lit(r"/\.\.?$"))
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    return F.when(folder & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_link(base: Column, link: Column) -> Column:
    """Absolute form of a link found on the page `base`."""
    root = base_url(base)
    page = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    page = F.when(page == "", F.lit("/")).otherwise(page)
    path = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_extract(page, r"^(.*/)", 1), path))
    full = F.when(F.regexp_like(full, F.lit(r"/\.\.?(/|$)")), _collapse_dots(full)).otherwise(full)
    return (
        F.when(link == "", base)
        .when(F.regexp_like(link, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), link)
        .when(link.startswith("//"), F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit(":"), link))
        .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
        .when(link.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
        .otherwise(F.concat(root, full, rest))
    )
