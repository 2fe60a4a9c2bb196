"""Entities mapped to other languages through their item ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.operators.ranks import first_by


def qid_pages(page: DataFrame, page_props: DataFrame) -> DataFrame:
    """page_title, qid of articles with an item."""
    props = page_props.where("pp_propname = 'wikibase_item'").select(F.col("pp_page").alias("page_id"), F.col("pp_value").alias("qid"))
    return page.where("page_namespace = 0").select("page_id", "page_title").distinct().join(props, "page_id").select("page_title", "qid")


def qid_mapping(entities: DataFrame, languages: list[str], qids: list[DataFrame]) -> DataFrame:
    """qid, ent_type and a title a language; the first language is that of entities(page_title, ent_type).

    Chained left joins: an item with several titles in a language gives
    several rows. A language without its table is an error.
    """
    if len(languages) != len(qids):
        raise ValueError(f"{len(languages)} languages but {len(qids)} tables of titles")
    first = qids[0].select("qid", F.col("page_title").alias(languages[0]))
    out = entities.select(F.col("page_title").alias(languages[0]), "ent_type").join(first, languages[0])
    for lang, q in zip(languages[1:], qids[1:]):
        out = out.join(q.select("qid", F.col("page_title").alias(lang)), "qid", "left")
    return out.select("qid", "ent_type", *languages)


def language_entities(mapping: DataFrame, lang: str) -> DataFrame:
    """page_title, ent_type in one language: rows without nulls, the first of each title by qid."""
    rows = mapping.select("qid", F.col(lang).alias("page_title"), "ent_type").where("page_title is not null and ent_type is not null")
    return first_by(rows, ["page_title"], ["qid", "ent_type"]).select("page_title", "ent_type")
