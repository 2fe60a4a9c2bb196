"""A-priori probabilities of entities from link counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.session import materialize


def links_of(tagged: DataFrame) -> DataFrame:
    """page_id, target: one row a link entry of the token lists."""
    flat = F.flatten(F.filter(F.from_json("link_titles", "array<array<string>>"), lambda x: x.isNotNull()))
    return tagged.select("page_id", F.explode(flat).alias("target")).where("target <> ''")


def apriori(entities: DataFrame, links: DataFrame) -> DataFrame:
    """entities with n_links and proba, their share of all links; 0 without links to them.

    One aggregate of the links, written once, so the join meets one row a target
    and their total is a sum of the same rows. With no
    links at all the share is undefined, and null.
    """
    entities = entities.drop("n_links", "proba")
    counts = links.groupBy(F.col("target").alias("page_title")).agg(F.count(F.lit(1)).alias("n_links"))
    counts = materialize(counts, "counts")
    total = counts.agg(F.sum("n_links").cast("double").alias("_total"))  # one row, null without links
    n = F.coalesce("n_links", F.lit(0))
    return entities.join(counts, "page_title", "left").join(F.broadcast(total)).withColumn("n_links", n).withColumn("proba", n.cast("double") / F.col("_total")).drop("_total")
