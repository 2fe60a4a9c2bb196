"""References to records that do not exist, per table and period."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.functions.titles import title_key
from tesserae.operators.skew import skew_lookup
from tesserae.session import materialize


def find_orphans(refs: DataFrame, parents: DataFrame, **skew: int) -> DataFrame:
    """References whose key is missing, deleted or loaded only later.

    refs: ref_table, ref_field, ref_id, ref_value, space, key, ref_ts.
    parents: space, key, live (the record stands), first_ts; keys may repeat.

    Parent and child keys are united in long form, tagged, and grouped by
    (space, key), both pre-aggregated; groups lacking the parent flag are
    missing. The references are written once and read for the keys, for the hot
    ones among them and for the verdicts (skew: options of skew_lookup), which,
    one a key, are looked up with hot keys salted. References with a null key
    refer to nothing and give no row; repeated references give one row per month
    and kind; empty inputs give no rows; a null ref_ts is never late and has the
    month null.
    """
    refs = materialize(refs.where("key is not null").select("ref_table", "ref_field", "ref_id", "ref_value", "space", "key", "ref_ts").distinct(), "references")
    tagged = refs.select("space", "key").groupBy("space", "key").agg(F.lit(False).alias("is_parent"), F.lit(None).cast("boolean").alias("live"), F.lit(None).cast(parents.schema["first_ts"].dataType).alias("first_ts"))
    owners = parents.where("key is not null").groupBy("space", "key").agg(F.lit(True).alias("is_parent"), F.max("live").alias("live"), F.coalesce(F.min(F.when(F.col("live"), F.col("first_ts"))), F.min("first_ts")).alias("first_ts"))
    verdicts = tagged.unionByName(owners).groupBy("space", "key").agg(F.max("is_parent").alias("has_parent"), F.max("live").alias("live"), F.min("first_ts").alias("first_ts"), F.min("is_parent").alias("all_parent")).where("not all_parent").drop("all_parent")
    joined = skew_lookup(refs, verdicts, ["space", "key"], "inner", **skew)
    kind = F.when(~F.col("has_parent"), "missing").when(~F.col("live"), "deleted").when(F.col("first_ts") > F.col("ref_ts"), "late")
    month = F.substring(F.col("ref_ts").cast("string"), 1, 7)
    return joined.select("ref_table", "ref_field", "ref_id", "ref_value", kind.alias("miss_kind"), month.alias("ref_month")).where("miss_kind is not null").distinct()


def orphan_counts(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """The counts of find_orphans per table, field, kind and month."""
    return find_orphans(refs, parents).groupBy("ref_table", "ref_field", "miss_kind", "ref_month").agg(F.count(F.lit(1)).alias("n_refs"), F.countDistinct("ref_value").alias("n_targets"))


def page_parents(page: DataFrame) -> DataFrame:
    """Page ids, and title keys within their namespace, as parents."""
    live = F.col("deleted_at").isNull().alias("live")
    ids = page.select(F.lit("id").alias("space"), F.col("page_id").cast("string").alias("key"), live, F.col("loaded_at").alias("first_ts"))
    titles = page.where("page_namespace is not null").select(F.concat(F.lit("ns"), F.col("page_namespace").cast("string")).alias("space"), title_key(F.col("page_title")).alias("key"), live, F.col("loaded_at").alias("first_ts"))
    return ids.unionByName(titles)


def page_references(redirect: DataFrame, tagged: DataFrame) -> DataFrame:
    """rd_from, rd_title and the link titles, in long form.

    Unreadable link lists refer to nothing, as null and "" do.
    """
    sources = redirect.select(F.lit("redirect").alias("ref_table"), F.lit("rd_from").alias("ref_field"), F.col("rd_from").alias("ref_id"), F.col("rd_from").cast("string").alias("ref_value"), F.lit("id").alias("space"), F.col("rd_from").cast("string").alias("key"), F.col("loaded_at").alias("ref_ts"))
    targets = redirect.select(F.lit("redirect").alias("ref_table"), F.lit("rd_title").alias("ref_field"), F.col("rd_from").alias("ref_id"), F.col("rd_title").alias("ref_value"), F.concat(F.lit("ns"), F.col("rd_namespace").cast("string")).alias("space"), title_key(F.col("rd_title")).alias("key"), F.col("loaded_at").alias("ref_ts"))
    titles = F.array_distinct(F.flatten(F.filter(F.from_json("link_titles", "array<array<string>>"), lambda s: s.isNotNull())))
    links = tagged.select("page_id", "loaded_at", F.explode(titles).alias("ref_value")).where("ref_value <> ''")
    links = links.select(F.lit("tagged").alias("ref_table"), F.lit("link_titles").alias("ref_field"), F.col("page_id").alias("ref_id"), "ref_value", F.lit("ns0").alias("space"), title_key(F.regexp_replace("ref_value", "(?s)#.*$", "")).alias("key"), F.col("loaded_at").alias("ref_ts"))
    return sources.unionByName(targets).unionByName(links)
