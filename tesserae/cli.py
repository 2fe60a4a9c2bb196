"""The commands of the engine: python -m tesserae.cli COMMAND ...; tables are Parquet folders unless said otherwise."""

from __future__ import annotations

import argparse
import functools

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.operators import apriori as ap, categories as cat, entity_table as et, linking as li, mapping as mp, redirects as rd, split as sp, wikitext as w
from tesserae.session import local_session, ship_package
from tesserae.sources import insertdump, sparql, wikixml
from tesserae.sources.sqlite import read_sqlite

# The category roots of the deprecated typed extraction.
ROOTS = (("Organisation", "org"), ("Geographisches_Objekt", "geo"), ("Geographischer_Begriff", "notion"), ("Frau", "per"), ("Mann", "per"))


def read(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """A Parquet folder; or, for FILE.sqlite, the table in it."""
    if table and path.endswith((".sqlite", ".sqlite3", ".db")):
        return read_sqlite(spark, path, table)
    return spark.read.parquet(f"{path}/{table}" if table else path)


def run_sparql(spark, a):
    text = sparql.query_text(a.query, a.query_file, a.demo, a.lang, a.site)
    sparql.run_sparql(spark, text, a.endpoint or sparql.ENDPOINT, a.analytic).write.mode("overwrite").parquet(a.out)


def join_entities(spark, a):
    parts = []
    for name, type_ord, _ in et.consumed():
        item = next(k for k, v in et.TYPES.items() if v == type_ord)
        df = spark.read.parquet(f"{a.path}/{a.lang}-{name}").withColumnRenamed(item, "wikidata")
        for c in ("dateofbirth", "inception"):
            if c in df.columns:
                df = df.withColumn(c, F.col(c).cast("string").try_cast("timestamp_ntz"))
        # rows of one extract have no order of their own; that of their values is stable
        parts.append(df.withColumn("src_class", F.lit(name)).withColumn("row_ord", F.struct(*[F.col(c).cast("string").alias(c) for c in sorted(df.columns)]).cast("string")))
    rows = functools.reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    works = spark.read.parquet(f"{a.path}/{a.lang}-work-of-arts").select(F.col("woa").alias("wikidata"))
    et.entity_table(rows, works, a.site).write.mode("overwrite").parquet(a.out)


def extract_full_text(spark, a):
    wikixml.write_pages(wikixml.read_pages(spark, a.xml), a.out, "overwrite")


def _typed(df: DataFrame) -> DataFrame:
    return df.select("page_title", F.col("ent_type" if "ent_type" in df.columns else "TYPE").alias("ent_type"))


def tag_entities(spark, a):
    page, redirect = read(spark, a.wikipedia, "page"), read(spark, a.wikipedia, "redirect")
    ents = _typed(spark.read.parquet(a.entities))
    numbers: dict[str, int] = {}
    docs = w.tagged_documents(spark.read.parquet(a.fulltext), page, ents, rd.entity_redirects(page, redirect, ents), numbers)
    print(f"{numbers['n_pages']} pages to tag, {numbers['n_redirects']} redirects")
    w.as_json(docs).write.mode("append").parquet(a.out)


def redirects_to_table(spark, a):
    ents = _typed(spark.read.parquet(a.entities))
    rd.entity_redirects(read(spark, a.wikipedia, "page"), read(spark, a.wikipedia, "redirect"), ents).write.mode("overwrite").parquet(a.out)


def redirects_to_entities(spark, a):
    ents = _typed(spark.read.parquet(a.entities))
    rd.resolved_entities(read(spark, a.wikipedia, "page"), read(spark, a.wikipedia, "redirect"), ents).write.mode("overwrite").parquet(a.out)


def compute_apriori(spark, a):
    wikixml.replace_table(ap.apriori(spark.read.parquet(a.entities), spark.read.parquet(a.links)).drop("n_links"), a.entities)


def train_test_split(spark, a):
    parts = sp.split(read(spark, a.wikipedia, "page"), a.train, a.dev, a.test, a.seed)
    for name, path in (("train", a.train_out), ("dev", a.dev_out), ("test", a.test_out)):
        parts.where(F.col("part") == name).drop("part").orderBy("page_id").write.mode("overwrite").parquet(path)


def link_tagged(spark, a):
    types = set(a.entity_types.split("|")) if a.entity_types else None
    client = functools.partial(li.HttpClient, a.endpoint, noproxy=a.noproxy)
    li.run(spark.read.parquet(a.tagged), client, types, a.min_count_per_doc, a.seed).write.mode("append").parquet(a.out)


def import_dump(spark, a):
    insertdump.read_inserts(spark, a.dump, a.table).write.mode("overwrite").parquet(a.out)


def extract_typed(spark, a):
    roles = spark.createDataFrame(list(ROOTS), "root string, role string")
    cat.typed_entities(read(spark, a.wikipedia, "page"), read(spark, a.wikipedia, "categorylinks"), roles).select("page_title", "ent_type").write.mode("overwrite").parquet(a.out)


def map_languages(spark, a):
    langs = a.languages.split("|")
    qids = [mp.qid_pages(read(spark, x, "page"), read(spark, x, "page_props")) for x in (a.wikipedia, *a.others)]
    mapping = mp.qid_mapping(_typed(spark.read.parquet(a.entities)), langs, qids)
    mapping.write.mode("overwrite").parquet(f"{a.out}/wikidata-mapping")
    wikixml.write_by_language({x: mp.language_entities(mapping, x) for x in langs}, a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tesserae")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name, f, *args, **options):
        c = sub.add_parser(name)
        for x in args:
            c.add_argument(x)
        for k, v in options.items():
            c.add_argument("--" + k.replace("_", "-"), **v)
        c.set_defaults(run=f)
        return c

    flag = {"action": "store_true"}
    command("run-sparql", run_sparql, "out", endpoint={}, query={}, query_file={}, analytic=flag, demo=flag, lang={}, site={})
    command("join-entities", join_entities, "path", "lang", "site", "out")
    command("extract-full-text", extract_full_text, "xml", "out")
    command("tag-entities", tag_entities, "fulltext", "entities", "wikipedia", "out")
    command("redirects", redirects_to_table, "entities", "wikipedia", "out")
    command("redirects-to-entities", redirects_to_entities, "wikipedia", "entities", "out")
    command("apriori-probs", compute_apriori, "entities", "links")
    c = command("train-test-split", train_test_split, "wikipedia", seed={"type": int, "default": 41})
    for x in ("train", "dev", "test"):
        c.add_argument(x, type=float)
    for x in ("train_out", "dev_out", "test_out"):
        c.add_argument(x)
    command("link-tagged", link_tagged, "tagged", "endpoint", "out", entity_types={}, min_count_per_doc={"type": int}, noproxy=flag, seed={"type": int, "default": 0})
    command("import-dump", import_dump, "dump", "table", "out")
    command("extract-typed", extract_typed, "wikipedia", "out")
    command("map-languages", map_languages, "out", "languages", "entities", "wikipedia").add_argument("others", nargs="*")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.getActiveSession() or local_session(app=a.command)
    ship_package(spark)
    a.run(spark, a)


if __name__ == "__main__":
    main()
