"""Class extracts from triples: instances of a class or its subclasses, with optional properties."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tesserae.operators.closure import closure


@dataclass(frozen=True)
class Extract:
    """One query: its root class, the name of its items, and its optional properties."""

    name: str
    root: str
    variable: str
    optional: tuple[str, ...] = ()
    order: int | None = None  # its place among the extracts of its type, if it is consumed
    matched: tuple[str, ...] = ()  # matched, so that rows multiply, but not returned


# Properties, and the fifteen extracts.
PROPERTIES = {"dateofbirth": "P569", "coords": "P625", "inception": "P571", "gndid": "P227"}
EXTRACTS = (
    Extract("subject", "Q830077", "person", ("dateofbirth", "gndid"), 0),
    Extract("fictional-character", "Q95074", "person", ("dateofbirth", "gndid"), 1),
    Extract("fictional-person", "Q97498056", "person", ("dateofbirth", "gndid"), 2),
    Extract("person", "Q215627", "person", ("gndid",), None, ("dateofbirth",)),
    Extract("geographic-entity", "Q27096213", "location", ("coords", "gndid"), 0),
    Extract("fictional-location", "Q3895768", "location", ("gndid",), 1),
    Extract("spatial-entity", "Q58416391", "location", ("coords", "gndid")),
    Extract("armed-organization", "Q17149090", "organisation", ("inception", "gndid"), 0),
    Extract("association", "Q15911314", "organisation", ("inception", "gndid"), 1),
    Extract("business", "Q4830453", "organisation", ("inception", "gndid"), 2),
    Extract("fictional-organisation", "Q14623646", "organisation", ("gndid",), 3),
    Extract("group-of-people", "Q16334295", "organisation", ("inception", "gndid"), 4),
    Extract("institution", "Q178706", "organisation", ("coords", "inception", "gndid"), 5),
    Extract("organ", "Q895526", "organisation", ("inception", "gndid"), 6),
    Extract("work-of-arts", "Q838948", "woa"),
)
BY_NAME = {e.name: e for e in EXTRACTS}


def objects(triples: DataFrame, pred: str, name: str, lang: str | None = None) -> DataFrame:
    own = triples.where(F.col("pred") == pred)
    if lang is not None:
        own = own.where(F.col("obj_lang") == lang)
    return own.select("subj", F.col("obj").alias(name))


def classes_below(triples: DataFrame, roots: list[str]) -> DataFrame:
    """root, node: each root and its transitive subclasses, all roots in one loop."""
    start = triples.sparkSession.createDataFrame([(r,) for r in roots], "root string")
    edges = triples.where("pred = 'P279'").select(F.col("obj").alias("parent"), F.col("subj").alias("child"))
    return closure(edges, start).select("root", "node")


def instances(triples: DataFrame, roots: list[str]) -> DataFrame:
    """root, subj for every class statement; an item of two classes below a root appears twice."""
    return objects(triples, "P31", "node").join(classes_below(triples, roots), "node").select("root", "subj")


def class_extract(triples: DataFrame, extract: Extract, lang: str, site: str) -> DataFrame:
    """The bag of solutions of one extract; all values are strings."""
    rows = instances(triples, [extract.root]).select("subj")
    if extract.variable == "woa":
        return rows.select(F.col("subj").alias("woa"))
    rows = rows.join(objects(triples, "label", "label", lang), "subj")
    about = triples.where((F.col("pred") == "about") & F.col("subj").contains(site)).select(F.col("obj").alias("subj"), F.col("subj").alias("sitelink"))
    rows = rows.join(about, "subj")
    for prop in (*extract.matched, *extract.optional):
        rows = rows.join(objects(triples, PROPERTIES[prop], prop), "subj", "left")
    return rows.select(F.col("subj").alias(extract.variable), "label", "sitelink", *extract.optional)
