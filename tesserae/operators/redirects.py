"""Redirects to entities, and entities without redirect titles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.operators.categories import pages
from tesserae.operators.ranks import first_by


def entity_redirects(page: DataFrame, redirect: DataFrame, entities: DataFrame) -> DataFrame:
    """rd_from_title, rd_title, ent_type: one redirect a source title, to titles of entities(page_title, ent_type)."""
    sources = redirect.select(F.col("rd_title").cast("string").alias("rd_title"), F.col("rd_from").alias("page_id")).join(pages(page, 0), "page_id").select("page_id", "rd_title", F.col("page_title").alias("rd_from_title"))
    hits = sources.join(entities.select(F.col("page_title").alias("rd_title"), "ent_type"), "rd_title")
    return first_by(hits.select("rd_from_title", "rd_title", "ent_type", "page_id"), ["rd_from_title"], ["rd_title", "page_id"]).select("rd_from_title", "rd_title", "ent_type")


def checked(redirects: DataFrame) -> DataFrame:
    """The same redirects; running it fails where a source title stands in several rows."""
    sole = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("several redirects of "), "rd_from_title"))).otherwise(F.first(F.struct("rd_title", "ent_type")))
    return redirects.groupBy("rd_from_title").agg(sole.alias("_r")).select("rd_from_title", "_r.rd_title", "_r.ent_type")


def duplicate_sources(page: DataFrame, redirect: DataFrame) -> DataFrame:
    """n_rows, n_titles, n_duplicates of redirect source titles."""
    rows = redirect.select(F.col("rd_from").alias("page_id")).join(pages(page, 0), "page_id")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("page_title").alias("n_titles")).withColumn("n_duplicates", F.col("n_rows") - F.col("n_titles"))


def resolved_entities(page: DataFrame, redirect: DataFrame, entities: DataFrame) -> DataFrame:
    """Entities whose title is no redirect to another entity."""
    return entities.join(entity_redirects(page, redirect, entities).select(F.col("rd_from_title").alias("page_title")), "page_title", "left_anti").select("page_title", "ent_type")
