"""Articles below categories, and entities typed by categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.operators.closure import closure


def pages(page: DataFrame, namespace: int) -> DataFrame:
    """page_id, page_title of a namespace, each once."""
    return page.where(F.col("page_namespace") == namespace).select("page_id", F.col("page_title").cast("string").alias("page_title")).distinct()


def members(page: DataFrame, categorylinks: DataFrame) -> DataFrame:
    """cl_to, cl_from and, if the member is a category itself, its page_id and page_title."""
    links = categorylinks.select(F.col("cl_to").cast("string").alias("cl_to"), "cl_from")
    return links.join(pages(page, 14), links["cl_from"] == F.col("page_id"), "left")


def category_closure(page: DataFrame, categorylinks: DataFrame, roots: DataFrame) -> DataFrame:
    """root, node, depth over category titles, for roots(root)."""
    return closure(members(page, categorylinks).where("page_title is not null").select(F.col("cl_to").alias("parent"), F.col("page_title").alias("child")), roots)


def member_ids(page: DataFrame, categorylinks: DataFrame, roots: DataFrame) -> DataFrame:
    """root, page_id of the members of all reached categories."""
    reached = category_closure(page, categorylinks, roots).select("root", F.col("node").alias("cl_to"))
    return categorylinks.select(F.col("cl_to").cast("string").alias("cl_to"), F.col("cl_from").alias("page_id")).join(reached, "cl_to").select("root", "page_id").distinct()


def listed(page: DataFrame, list_prefix: str) -> DataFrame:
    """page_id, page_title of articles that are no lists."""
    return pages(page, 0).where(F.col("page_title").isNotNull() & ~F.col("page_title").startswith(list_prefix))


def member_rows(page: DataFrame, categorylinks: DataFrame, roots: DataFrame) -> DataFrame:
    """root, cl_from, page_id, page_title: the members of all reached categories, distinct whatever their parent."""
    reached = category_closure(page, categorylinks, roots).select("root", F.col("node").alias("cl_to"))
    return members(page, categorylinks).join(reached, "cl_to").select("root", "cl_from", "page_id", "page_title").distinct()


def category_pages(page: DataFrame, categorylinks: DataFrame, roots: DataFrame, list_prefix: str = "Liste_") -> DataFrame:
    """root, page_id, page_title of the articles below each root, without lists."""
    return member_ids(page, categorylinks, roots).join(listed(page, list_prefix), "page_id").select("root", "page_id", "page_title")


def typed_entities(page: DataFrame, categorylinks: DataFrame, roles: DataFrame, list_prefix: str = "Liste_") -> DataFrame:
    """page_id, page_title, ent_type by roles(root, role): org, geo, notion and any number of per.

    Organisations that are persons or (unpruned) places are dropped, places
    that are persons or geographic notions too. roles, a handful of names
    given by hand, may repeat a root.
    """
    reached = member_ids(page, categorylinks, roles.select("root")).join(F.broadcast(roles), "root")
    has = {r: F.coalesce(F.bool_or(F.col("role") == r), F.lit(False)).alias(r) for r in ("per", "geo", "notion", "org")}
    flags = reached.groupBy("page_id").agg(*has.values())
    per, geo, notion, org = (F.col(r) for r in has)
    kinds = F.array_compact(F.array(F.when(per, "PER"), F.when(geo & ~per & ~notion, "LOC"), F.when(org & ~per & ~geo, "ORG")))
    return flags.join(listed(page, list_prefix), "page_id").select("page_id", "page_title", F.explode(kinds).alias("ent_type"))


def disambiguation_pages(page: DataFrame, categorylinks: DataFrame, root: DataFrame) -> DataFrame:
    return category_pages(page, categorylinks, root).select("page_id", "page_title")
