"""The typed entity table from class extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.functions import scalars as s
from tesserae.operators.ranks import first_by
from tesserae.operators.triples import EXTRACTS

VALUES = ("coords", "dateofbirth", "gndid", "inception", "label", "sitelink")
TYPES = {"person": 0, "location": 1, "organisation": 2}


def consumed() -> list[tuple[str, int, int]]:
    """(src_class, type_ord, class_ord) of the extracts that the table is built from."""
    return [(e.name, TYPES[e.variable], e.order) for e in EXTRACTS if e.order is not None]


def type_sets(rows: DataFrame, works: DataFrame) -> DataFrame:
    """Of rows(wikidata, values, src_class, row_ord) the first per type and item, without works of art.

    First is by the order of the extracts within the type, then by row_ord.
    """
    orders = F.create_map(*[x for name, t, c in consumed() for x in (F.lit(name), F.struct(F.lit(t).alias("type_ord"), F.lit(c).alias("class_ord")))])
    rows = rows.select("wikidata", *VALUES, "src_class", "row_ord")
    placed = rows.withColumn("_o", orders[F.col("src_class")]).where("_o is not null").select("*", "_o.type_ord", "_o.class_ord").drop("_o")
    kept = first_by(placed, ["type_ord", "wikidata"], ["class_ord", "row_ord"])
    return kept.join(works.select("wikidata").where("wikidata is not null").distinct(), "wikidata", "left_anti").where("wikidata is not null")


def merged(sets: DataFrame) -> DataFrame:
    """One row per item: the first non-null value of each column by type, and the flags, in one aggregate."""
    firsts = [F.expr(f"min_by({c}, type_ord) FILTER (WHERE {c} IS NOT NULL)").alias(c) for c in VALUES]
    flags = [F.bool_or(F.col("type_ord") == t).alias(f) for f, t in (("is_per", 0), ("is_loc", 1), ("is_org", 2))]
    return sets.groupBy("wikidata").agg(*firsts, *flags)


def flagged(items: DataFrame) -> DataFrame:
    """PER yields to ORG; ent_type joins the flags."""
    out = items.withColumn("is_per", F.col("is_per") & ~F.col("is_org"))
    return out.withColumn("ent_type", s.type_of_flags(F.col("is_per"), F.col("is_loc"), F.col("is_org")))


def entity_table(rows: DataFrame, works: DataFrame, site: str, strict_coords: bool = False) -> DataFrame:
    """The table, one row a title: type sets, merge, flags, coordinates, titles, the earliest of each title.

    Of items that share a title the one born, then founded, first stays
    (nulls last), then the smallest item; flags are set before that.
    """
    items = flagged(merged(type_sets(rows, works)))
    full = items.select(
        s.title_of_sitelink(F.col("sitelink"), site).alias("page_title"), "wikidata", *VALUES,
        s.longitude(F.col("coords"), strict_coords).alias("longitude"), s.latitude(F.col("coords"), strict_coords).alias("latitude"),
        "is_per", "is_loc", "is_org", "ent_type", s.item_id(F.col("wikidata")).alias("qid"),
    )
    return first_by(full, ["page_title"], ["dateofbirth", "inception", "wikidata"])
