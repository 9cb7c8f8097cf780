"""Text normalisation (cleaning, tokens, names, sentences)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from venuemart import lexicons

# Whitespace as in str.split: Unicode blanks and the four ASCII separators.
BLANK = r"[\s\x1c-\x1f]"
_DELETED = "[" + "".join("\\" + c if c in "\\[]^-&" else c for c in lexicons.PUNCTUATION) + r"\p{Nd}]+"


def utrim(c: Column) -> Column:
    """Strip every kind of whitespace from both ends (`trim` strips only the space)."""
    return F.regexp_replace(c, f"(?U)^{BLANK}+|{BLANK}+$", "")


def not_blank(c: Column) -> Column:
    return c.isNotNull() & F.regexp_like(c, F.lit(r"(?U)[^\s\x1c-\x1f]"))


def clean_text(c: Column) -> Column:
    """Lower case, punctuation and digits deleted, whitespace runs made one space."""
    kept = F.regexp_replace(F.lower(c), _DELETED, "")
    return F.trim(F.regexp_replace(kept, f"(?U){BLANK}+", " "))


def tokens(c: Column) -> Column:
    """Whitespace tokens; a blank text has none."""
    return F.filter(F.split(c, f"(?U){BLANK}+"), lambda t: t != "")


def sentences(c: Column) -> Column:
    """Parts between full stops, untrimmed, blank ones included."""
    return F.split(c, r"\.")


def map_values_of(c: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Replace whole values; others become `default` (NULL if not given)."""
    out = default if default is not None else F.lit(None)
    for key, value in reversed(list(mapping.items())):
        out = F.when(c == F.lit(key), F.lit(value)).otherwise(out)
    return out


def name_norm(c: Column, strict_reference: bool = False) -> Column:
    """Lower-case venue name without its generic first word and quotes, known typos corrected.

    The typo table is written in mixed case while names are lower case; `strict_reference` keeps that
    mismatch, under which no typo is ever corrected.
    """
    body = F.regexp_extract(F.lower(c), "(?s)" + lexicons.NAME_PATTERN, 1)
    name = F.when(c != "", F.btrim(body, F.lit(lexicons.NAME_QUOTES)))
    typos = lexicons.NAME_TYPOS
    if not strict_reference:
        typos = {k.lower(): v.lower() for k, v in typos.items()}
    return map_values_of(name, typos, name)
