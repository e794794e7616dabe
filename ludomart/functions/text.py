"""Text and number helpers, all JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Listing phrases that say something about the copy, not the item.
LISTING_NOISE = r"\b(brand new|sealed|[0-9]+(st|nd|rd|th) ed(ition)?)\b"


def lenient_int(value: Column) -> Column:
    """Integer or NULL; ``1999.0`` is 1999."""
    return F.coalesce(value.try_cast("int"), value.try_cast("double").try_cast("int"))


def join_list(items: Column) -> Column:
    """Comma-joined text. NULL items are skipped; a NULL list gives the empty text."""
    return F.concat_ws(",", items)


def primary_name(names: Column) -> Column:
    """The last name marked primary, else the first name (XML ``name`` elements)."""
    primary = F.filter(names, lambda n: n["_primary"].isNotNull())
    marked = F.try_element_at(primary, F.lit(-1))["_VALUE"]
    return F.coalesce(F.when(marked != "", marked), F.get(names, F.lit(0))["_VALUE"])


def clean_name(name: Column) -> Column:
    """Normal form for matching: lower case, letters and digits, no listing noise."""
    plain = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, LISTING_NOISE, " "), " +", " "))
