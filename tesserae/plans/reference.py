"""Queries of the knowledge-base operators over the test tables, and their SQL."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.functions import scalars as s
from tesserae.operators import apriori as ap, categories as cat, entity_table as et, linking as li, mapping as mp, redirects as rd, split as sp, triples as tr, wikitext as w
from tesserae.operators.ranks import first_by
from tesserae.session import materialize, scratch
from tesserae.sources import insertdump, sparql, sqlite, wikixml
from tesserae.tables import table

CONTROLS = "[\\x00-\\x08\\x0b-\\x1f\ufffe\uffff]"
SITE = "https://de.wiki.example/wiki/"

# ---- tables that the test data has in another shape --------------------------

# Both dialects read these.
WORKS = "SELECT DISTINCT wikidata FROM {entities} WHERE wikidata IS NOT NULL AND ent_id % 29 = 0"
PAGE_PROPS = """SELECT DISTINCT page_id AS pp_page, 'wikibase_item' AS pp_propname, 'Q' || CAST(page_id AS STRING) AS pp_value FROM {page} WHERE page_id % 5 <> 0
UNION ALL SELECT DISTINCT page_id, 'displaytitle', page_title FROM {page} WHERE page_id % 7 = 0"""
# Further languages: each knows a part of the items, and one of them some items twice.
OTHER = """SELECT DISTINCT '{lang}:' || page_title AS page_title, 'Q' || CAST(page_id AS STRING) AS qid FROM {page} WHERE page_namespace = 0 AND page_id % {part} <> 0
UNION ALL SELECT DISTINCT '{lang}2:' || page_title, 'Q' || CAST(page_id AS STRING) FROM {page} WHERE page_namespace = 0 AND page_id % {twice} = 0"""
TRIPLES = """SELECT DISTINCT wikidata AS subj, 'P31' AS pred, 'class:' || src_class AS obj, CAST(NULL AS STRING) AS obj_lang FROM {entities} WHERE wikidata IS NOT NULL AND src_class IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'label', label, CASE WHEN ent_id % 3 = 0 THEN 'en' ELSE 'de' END FROM {entities} WHERE wikidata IS NOT NULL AND label IS NOT NULL
UNION ALL SELECT DISTINCT sitelink, 'about', wikidata, NULL FROM {entities} WHERE wikidata IS NOT NULL AND sitelink IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'P625', coords, NULL FROM {entities} WHERE wikidata IS NOT NULL AND coords IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'P569', CAST(dateofbirth AS STRING), NULL FROM {entities} WHERE wikidata IS NOT NULL AND dateofbirth IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'P571', CAST(inception AS STRING), NULL FROM {entities} WHERE wikidata IS NOT NULL AND inception IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'P227', gndid, NULL FROM {entities} WHERE wikidata IS NOT NULL AND gndid IS NOT NULL
UNION ALL SELECT DISTINCT wikidata, 'P31', 'Q838948', NULL FROM {entities} WHERE wikidata IS NOT NULL AND ent_id % 29 = 0
""" + "".join(f"UNION ALL SELECT 'class:{e.name}', 'P279', 'mid:{e.name}', NULL\nUNION ALL SELECT 'mid:{e.name}', 'P279', '{e.root}', NULL\nUNION ALL SELECT '{e.root}', 'P279', 'mid:{e.name}', NULL\n" for e in tr.EXTRACTS if e.variable != "woa") + "UNION ALL SELECT 'class:subject', 'P279', 'Q215627', NULL"  # fmt: skip
# The five roots of the typed extraction: the first categories without a parent that have the most members.
ROLES = """SELECT page_title AS root, CASE n WHEN 1 THEN 'org' WHEN 2 THEN 'geo' WHEN 3 THEN 'notion' ELSE 'per' END AS role FROM (
SELECT page_title, row_number() OVER (ORDER BY m DESC, page_title) AS n FROM (SELECT * FROM (SELECT p.page_title, count(*) AS m FROM (SELECT DISTINCT page_id, page_title FROM {page} WHERE page_namespace = 14) p
JOIN {categorylinks} c ON c.cl_to = p.page_title GROUP BY p.page_title) a ORDER BY m DESC, page_title LIMIT 5) b) c"""


def _sql(spark: SparkSession, d: str, text: str, **extra: str) -> DataFrame:
    names = [n for n in ("page", "entities", "categorylinks", "redirect", "tagged", "text") if "{" + n + "}" in text]
    return spark.sql(text, **{n: table(spark, d, n) for n in names}, **extra)


def _t(spark: SparkSession, d: str, *names: str) -> tuple[DataFrame, ...]:
    return tuple(table(spark, d, n) for n in names)


def _typed(spark: SparkSession, d: str) -> DataFrame:
    """page_title, ent_type, the first row of each title."""
    rows = table(spark, d, "entities").where("page_title is not null and ent_type is not null").select("page_title", "ent_type", "ent_id")
    return first_by(rows, ["page_title"], ["ent_id"]).select("page_title", "ent_type")


def _rows(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "entities").where(F.col("sitelink").contains(SITE))
    return e.select("wikidata", *et.VALUES, "src_class", F.col("ent_id").alias("row_ord"))


def _works(spark: SparkSession, d: str) -> DataFrame:
    return _sql(spark, d, WORKS)


def _roles(spark: SparkSession, d: str) -> DataFrame:
    return materialize(_sql(spark, d, ROLES), "roles")


def _role(spark: SparkSession, d: str, role: str) -> DataFrame:
    return _roles(spark, d).where(F.col("role") == role).select("root").limit(1)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text").where("text is not null").select("page_id", F.md5("text").alias("doc_key"), "text").distinct()


# ---- queries ------------------------------------------------------------------


def apriori_probs(spark, d):
    ents = table(spark, d, "entities").where("page_title is not null").select("page_title").distinct()
    return ap.apriori(ents, ap.links_of(table(spark, d, "tagged")))


def ns0_articles(spark, d):
    return sp.articles(table(spark, d, "page"))


def category_members(spark, d):
    return cat.members(*_t(spark, d, "page", "categorylinks"))


def category_closure(spark, d):
    return cat.category_closure(*_t(spark, d, "page", "categorylinks"), _roles(spark, d).select("root")).select("root", "node")


def category_member_rows(spark, d):
    return cat.member_rows(*_t(spark, d, "page", "categorylinks"), _roles(spark, d).select("root"))


def category_pages(spark, d):
    return cat.category_pages(*_t(spark, d, "page", "categorylinks"), _roles(spark, d).select("root"))


def typed_entities(spark, d):
    return cat.typed_entities(*_t(spark, d, "page", "categorylinks"), _roles(spark, d))


def disambiguation_pages(spark, d):
    return cat.disambiguation_pages(*_t(spark, d, "page", "categorylinks"), _role(spark, d, "notion"))


def redirect_sources(spark, d):
    return rd.entity_redirects(*_t(spark, d, "page", "redirect"), _typed(spark, d))


def redirect_duplicates(spark, d):
    return rd.duplicate_sources(*_t(spark, d, "page", "redirect"))


def redirects_to_entities(spark, d):
    return rd.resolved_entities(*_t(spark, d, "page", "redirect"), _typed(spark, d))


def _props(spark, d):
    return _sql(spark, d, PAGE_PROPS)


def qid_pages(spark, d):
    return mp.qid_pages(table(spark, d, "page"), _props(spark, d))


def qid_mapping(spark, d):
    page = table(spark, d, "page")
    fr, en = (spark.sql(OTHER.replace("{lang}", x).replace("{part}", str(p)).replace("{twice}", str(t)), page=page) for x, p, t in (("fr", 3, 11), ("en", 4, 13)))
    return mp.qid_mapping(_typed(spark, d), ["de", "fr", "en"], [mp.qid_pages(page, _props(spark, d)), fr, en])


def lang_entities(spark, d):
    m = qid_mapping(spark, d)
    return mp.language_entities(m, "fr")


def _triples(spark, d):
    return _sql(spark, d, TRIPLES)


def instance_of_closure(spark, d):
    return tr.instances(_triples(spark, d), [e.root for e in tr.EXTRACTS])


def _extract(name):
    return lambda spark, d: tr.class_extract(_triples(spark, d), tr.BY_NAME[name], "de", SITE)


def works_exclusion(spark, d):
    return tr.class_extract(_triples(spark, d), tr.BY_NAME["work-of-arts"], "de", SITE)


def type_sets(spark, d):
    return et.type_sets(_rows(spark, d), _works(spark, d)).select("type_ord", "wikidata", "src_class", "row_ord", "label")


def _merged(spark, d):
    return et.merged(et.type_sets(_rows(spark, d), _works(spark, d)))


def entity_first_nonnull(spark, d):
    return _merged(spark, d).select("wikidata", *et.VALUES)


def entity_coords(spark, d):
    c = F.col("coords")
    return table(spark, d, "entities").select("ent_id", "coords", s.longitude(c).alias("longitude"), s.latitude(c).alias("latitude"), s.longitude(c, True).alias("longitude_strict"), s.latitude(c, True).alias("latitude_strict"))


def entity_title(spark, d):
    return table(spark, d, "entities").select("ent_id", s.title_of_sitelink(F.col("sitelink"), SITE).alias("title"))


def entity_dates(spark, d):
    text = F.when(F.col("ent_id") % 7 == 0, F.concat(F.lit("t"), F.col("ent_id").cast("string"))).otherwise(F.coalesce(F.col("dateofbirth"), F.col("inception")).cast("string"))
    return table(spark, d, "entities").select("ent_id", s.parse_date(text).alias("parsed"))


def entity_qid(spark, d):
    return table(spark, d, "entities").select("ent_id", s.item_id(F.col("wikidata")).alias("item"))


def entity_flags_type(spark, d):
    return et.flagged(_merged(spark, d)).select("wikidata", "is_per", "is_loc", "is_org", "ent_type")


def entity_table(spark, d):
    return et.entity_table(_rows(spark, d), _works(spark, d), SITE)


def _cleaning(step):
    return lambda spark, d: _docs(spark, d).select("page_id", "doc_key", step(F.col("text")).alias("clean"))


def clean_text(spark, d):
    return w.cleaned(_docs(spark, d)).select("page_id", "doc_key", "clean")


def _parts(spark, d):
    return w.link_parts(clean_text(spark, d), ["page_id", "doc_key"])


KEYS = ["page_id", "doc_key"]


def _documents(spark, d):
    ents = _typed(spark, d)
    return w.resolved_documents(w.parted(_docs(spark, d), KEYS), KEYS, ents, rd.entity_redirects(*_t(spark, d, "page", "redirect"), ents))


def _resolved(spark, d):
    return w.resolved_parts(_documents(spark, d), KEYS)


def _tokens(spark, d):
    return w.tokens_of(_documents(spark, d), KEYS)


def sentences(spark, d):
    return w.sentences_of(_documents(spark, d), KEYS)


def tagged_documents(spark, d):
    ents = _typed(spark, d)
    text = table(spark, d, "text")
    docs = w.tagged_documents(text, table(spark, d, "page"), ents, rd.entity_redirects(*_t(spark, d, "page", "redirect"), ents))
    flat = lambda c: F.array_join(F.transform(c, lambda x: F.array_join(x, " ")), "\n").alias(c)
    return docs.select("page_id", "page_title", flat("text"), flat("tags"), flat("link_titles"))


def train_dev_test(spark, d):
    return sp.split(table(spark, d, "page"), 0.6, 0.2, 0.15)


def ner_payload(spark, d):
    rows = li.payload(table(spark, d, "tagged").distinct()).select("page_id", F.posexplode("sentences").alias("sentence", "_s"))
    return rows.select("page_id", "sentence", F.posexplode("_s").alias("token", "_t")).select("page_id", "sentence", "token", "_t.word", "_t.prediction", "_t.gt")


def _parsed(spark, d):
    """What a service would find: the beginnings of tagged names."""
    rows = ner_payload(spark, d).where("prediction like 'B-%'")
    key = F.concat("word", F.lit("-"), F.substring("prediction", 3, 99))
    return first_by(rows.select("page_id", key.alias("entity_id"), "gt", "sentence", "token"), ["page_id", "entity_id"], ["sentence", "token", "gt"]).select("page_id", F.col("page_id").cast("string").alias("page_title"), "entity_id", "gt")


def linking_filter(spark, d):
    return li.filter_entities(_parsed(spark, d), {"PER", "LOC"}, 3)


def linking_flatten(spark, d):
    n = F.length("entity_id")
    answer = lambda i: F.struct(F.concat(F.lit(f"c{i}:"), "entity_id").alias("label"), F.concat(F.lit("Q"), n.cast("string")).alias("wikidata"), (F.lit(1.0) / (i + 1)).alias("proba"))
    ranking = F.when(n % 4 == 0, F.array().cast("array<struct<label:string,wikidata:string,proba:double>>")).when(n % 4 > 1, F.slice(F.array(answer(1), answer(2)), F.lit(1), (n % 4 - 1).cast("int")))
    return li.flatten_rankings(_parsed(spark, d).withColumn("ranking", ranking))


def xml_pages(spark, d):
    """The articles written as a dump and read again; control characters have no place in XML, so texts lose them first."""
    docs = table(spark, d, "text").where("text is not null").select("page_id", "title", F.regexp_replace("text", CONTROLS, " ").alias("text")).distinct()
    dump = docs.select("title", F.col("page_id").alias("id"), F.struct(F.struct(F.col("text").alias("_VALUE"), F.lit("1").alias("_bytes")).alias("text")).alias("revision"))
    folder = scratch(spark, "dump")
    wikixml.write_dump(dump, folder)
    read = wikixml.read_pages(spark, folder)
    return read.select("page_id", "title", F.md5(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[ \\t\\n]+", " "))).alias("digest"))


def insert_dump(spark, d):
    """Pages written as a dump of INSERT statements and read again."""
    own = table(spark, d, "page").select("page_id", "page_namespace", "page_title", "page_lang")
    folder = scratch(spark, "inserts")
    insertdump.write_inserts(own, folder, "page")
    return insertdump.read_inserts(spark, folder, "page")


def sqlite_tables(spark, d):
    """Redirects replaced, then appended to, in SQLite, and read by ranges of rows."""
    own = table(spark, d, "redirect").select("rd_from", "rd_namespace", "rd_title")
    folder = scratch(spark, "sqlite")
    if folder.startswith("file:") or "://" not in folder:
        path = folder.removeprefix("file://")
        Path(path).mkdir(parents=True)
        sqlite.write_sqlite(own.where("rd_namespace = 0"), f"{path}/x.db", "redirect", "overwrite", ("rd_from",))
        sqlite.write_sqlite(own.where("rd_namespace is distinct from 0"), f"{path}/x.db", "redirect")
        return sqlite.read_sqlite(spark, f"{path}/x.db", "redirect")
    raise RuntimeError("SQLite needs a shared folder that is mounted")


def page_ranges(spark, d):
    """Articles appended in two batches as ranges of ids, and what the ranges hold."""
    own = table(spark, d, "text").select("page_id", "title", "text").where("page_id is not null")
    path = scratch(spark, "pages")
    wikixml.write_pages(own.where("page_id % 2 = 0"), path)
    wikixml.write_pages(own.where("page_id % 2 = 1"), path)
    return spark.read.parquet(path).groupBy(F.col("range").cast("long").alias("page_range")).agg(F.count(F.lit(1)).alias("n_pages"), F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))


def replaced_table(spark, d):
    """The a-priori table, replaced by one made from itself."""
    path = scratch(spark, "apriori")
    apriori_probs(spark, d).write.parquet(path)
    wikixml.replace_table(spark.read.parquet(path).where("n_links > 0").drop("proba"), path)
    return spark.read.parquet(path)


def language_tables(spark, d):
    """One table a language, read back."""
    m = qid_mapping(spark, d)
    folder = scratch(spark, "languages")
    wikixml.write_by_language({x: mp.language_entities(m, x) for x in ("de", "fr", "en")}, folder)
    parts = [spark.read.parquet(f"{folder}/{x}-entities").withColumn("lang", F.lit(x)) for x in ("de", "fr", "en")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sparql_results(spark, d):
    """The trusted classes as an endpoint would answer."""
    rows = table(spark, d, "class_trust").collect()  # a small fixed table
    found = [{k: {"value": str(v)} for k, v in (("class", r["src_class"]), ("rank", r["trust_rank"])) if v is not None} for r in rows]
    return sparql.run_sparql(spark, "SELECT ?class ?rank WHERE { }", get=lambda url: json.dumps({"results": {"bindings": found}})).select("class", "rank")


def tagged_json(spark, d):
    ents = _typed(spark, d)
    return w.as_json(w.tagged_documents(table(spark, d, "text"), table(spark, d, "page"), ents, rd.entity_redirects(*_t(spark, d, "page", "redirect"), ents)))


def tagging_numbers(spark, d):
    ents, numbers = _typed(spark, d), {}
    w.tagged_documents(table(spark, d, "text"), table(spark, d, "page"), ents, rd.checked(rd.entity_redirects(*_t(spark, d, "page", "redirect"), ents)), numbers)
    return spark.createDataFrame([(numbers["n_pages"], numbers["n_redirects"])], "n_pages long, n_redirects long")


def tagged_page(spark, d):
    """The article with the smallest id, tagged by itself."""
    ents = _typed(spark, d)
    first = table(spark, d, "text").where("page_id is not null and text is not null").agg(F.min(F.struct("page_id", F.md5("text").alias("k"), "title", "text")).alias("x")).select("x.*").collect()[0]
    docs = w.tagged_page(first["page_id"], first["title"], first["text"], ents, rd.entity_redirects(*_t(spark, d, "page", "redirect"), ents))
    flat = lambda c: F.array_join(F.transform(c, lambda x: F.array_join(x, " ")), "\n").alias(c)
    return docs.select("page_id", "page_title", flat("text"), flat("tags"), flat("link_titles"))


class RuleService:
    """A linking service by rule: names are found by their tags, candidates by the length of a name's id."""

    def parse(self, sentences: list) -> dict:
        out: dict[str, dict] = {}
        for snt in sentences:
            for t in snt:
                if (t.get("prediction") or "").startswith("B-"):
                    out.setdefault(f"{t['word']}-{t['prediction'][2:]}", {"gt": [t.get("gt")]})
        return out

    def ned(self, parsed: dict) -> dict:
        made = lambda k, i: [f"c{i}:{k}", {"wikidata": f"Q{len(k)}", "proba_1": 1 / (i + 1)}]
        return {k: {} if len(k) % 4 == 1 else {"ranking": [made(k, i) for i in range(1, max(len(k) % 4, 1))]} for k in parsed}


def linking_run(spark, d):
    pages = table(spark, d, "tagged").drop("loaded_at").distinct().withColumn("page_title", F.col("page_id").cast("string"))
    return li.run(pages, RuleService, {"PER", "LOC"}, 3, seed=7)


QUERIES = {
    f.__name__.lstrip("_"): f
    for f in (apriori_probs, ns0_articles, category_members, category_closure, category_member_rows, category_pages, typed_entities, disambiguation_pages, redirect_sources, redirect_duplicates, redirects_to_entities, qid_pages, qid_mapping, lang_entities, instance_of_closure, works_exclusion, type_sets, entity_first_nonnull, entity_coords, entity_title, entity_dates, entity_qid, entity_flags_type, entity_table, clean_text, sentences, tagged_documents, train_dev_test, ner_payload, linking_filter, linking_flatten, xml_pages, insert_dump, sqlite_tables, page_ranges, replaced_table, language_tables, sparql_results, tagged_json, tagging_numbers, tagged_page, linking_run)
}
QUERIES |= {"class_extract_person": _extract("subject"), "class_extract_location": _extract("geographic-entity"), "class_extract_organisation": _extract("institution"), "class_extract_person_undated": _extract("person")}
QUERIES |= {"class_extract_" + e.name.replace("-", "_"): _extract(e.name) for e in tr.EXTRACTS if e.name not in ("subject", "geographic-entity", "institution", "person", "work-of-arts")}
QUERIES |= {step.__name__: _cleaning(step) for step in w.STEPS}
QUERIES |= {"link_parts": _parts, "link_resolution": _resolved, "tokens_bio": _tokens}
