"""Scalar functions of the entity pipeline, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The looks of a point, an item id and a title's anchor.
POINT_COMPAT = r"Point\(([\-0-9E.]+)\W.([\-0-9E.]+)\)"
POINT_STRICT = r"Point\(([\-0-9E.]+)\W([\-0-9E.]+)\)"
ITEM_ID = r"(Q[0-9]+)"
ANCHOR = r"^#?([^#]*)"


def longitude(coords: Column, strict: bool = False) -> Column:
    return F.nullif(F.regexp_extract(coords, POINT_STRICT if strict else POINT_COMPAT, 1), F.lit(""))


def latitude(coords: Column, strict: bool = False) -> Column:
    """By default the first character after the separator is lost, as users of the data expect; strict keeps it."""
    return F.nullif(F.regexp_extract(coords, POINT_STRICT if strict else POINT_COMPAT, 2), F.lit(""))


def item_id(wikidata: Column) -> Column:
    return F.nullif(F.regexp_extract(wikidata, ITEM_ID, 1), F.lit(""))


def parse_date(text: Column, nanosecond_range: bool = False) -> Column:
    """Timestamps, year first; what is no date becomes null. nanosecond_range: so does what 64-bit nanoseconds can't hold."""
    ts = text.try_cast("timestamp_ntz")
    if nanosecond_range:
        ts = F.when((ts >= F.lit("1677-09-22").cast("timestamp_ntz")) & (ts < F.lit("2262-04-11").cast("timestamp_ntz")), ts)
    return ts


def percent_decode(text: Column) -> Column:
    """`+` stays, and so do escapes that are none."""
    safe = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), text)


def title_of_sitelink(sitelink: Column, site: str) -> Column:
    return percent_decode(F.replace(sitelink, F.lit(site), F.lit("")))


def underscored(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit("_"))


def without_anchor(title: Column) -> Column:
    return F.regexp_extract(title, ANCHOR, 1)


def type_of_flags(per: Column, loc: Column, org: Column) -> Column:
    """PER, LOC, ORG joined by `|`; the flag PER must already yield to ORG."""
    return F.concat_ws("|", F.when(per, "PER"), F.when(loc, "LOC"), F.when(org, "ORG"))
