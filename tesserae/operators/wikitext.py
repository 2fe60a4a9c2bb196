"""Wiki text to tagged tokens: cleaning, links, resolution, tokens, sentences, documents.

Everything is a Column expression or a join, so it runs in generated code; no
Python is called for a row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions import scalars as s
from tesserae.operators.skew import skew_lookup
from tesserae.session import materialize, written_sums

# The patterns of the cleaning steps. (?s): across lines; (?d): only \n ends a line.
REFERENCES = r"(?s)== (Literatur|Références|References|Bibliographie|Further reading) ==.*$"
FILMS = r"(?s)== (Filme|Film|Filmographie|Œuvres) ==.*$"
COMMENT = r"(?s)<!--.*?-->"
SINGLE_TAG = r"(?s)<[^<]*?/>"
PAIRED_TAG = r"(?s)<[^/]+?>.*?</.+?>"
TABLE = r"(?s)\{\|(?:(?!\{\||\|\}).)*+\|\}"  # possessive: long tables need no stack
TEMPLATE = r"(?s)\{\{[^{]+?\}\}"
HEADING = r"(?s)={2,10}.*?={2,10}"
PROTECT = r"\[\[([^|\[]*?)([|]?)([^|]+?)\]\]"
FILE_LINK = r"(?d)\[\[(Datei|Fichier|File):.+?\]\]"
WEB_LINK = r"(?d)\[https?://.+?\]"
RESTORE = r"\{\|([^|\[]*?)([|]?)([^|]+?)\|\}"
LINK = r"\[\[([^|\[]*?)[|]?([^|]+?)\]\]"
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"

ENDS = (".", "!", "?")
PASSES, MOST = 6, 1000


def to_fixpoint(text: Column, pattern: str, opening: str) -> Column:
    """Remove the innermost matches until there are none, at most 1,000 times.

    A few passes run for every text; where something is left, as many more
    as it has openings, which bounds how deep they nest.
    """
    once = lambda acc, _: F.regexp_replace(acc, pattern, "")
    few = F.aggregate(F.sequence(F.lit(1), F.lit(PASSES)), text, once)
    left = F.least(F.size(F.split(few, opening)), F.lit(MOST - PASSES))
    return F.when(few.rlike(pattern), F.aggregate(F.sequence(F.lit(1), left), few, once)).otherwise(few)


def clean_references(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(t, REFERENCES, ""), FILMS, "")


def clean_comments(t: Column) -> Column:
    return F.regexp_replace(t, COMMENT, " ")


def clean_tags(t: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(t, SINGLE_TAG, " "), PAIRED_TAG, " ")


def clean_tables(t: Column) -> Column:
    return to_fixpoint(t, TABLE, r"\{\|")


def clean_templates(t: Column) -> Column:
    return to_fixpoint(t, TEMPLATE, r"\{\{")


def clean_headings(t: Column) -> Column:
    return F.replace(F.regexp_replace(t, HEADING, " "), F.lit("&nbsp;"), F.lit(" "))


def clean_links(t: Column) -> Column:
    """Links with at most one pipe are set aside while file and web links are removed."""
    t = F.regexp_replace(t, PROTECT, r"{|$1$2$3|}")
    t = F.regexp_replace(F.regexp_replace(t, FILE_LINK, ""), WEB_LINK, "")
    return F.regexp_replace(t, RESTORE, r"[[$1$2$3]]")


STEPS = (clean_references, clean_comments, clean_tags, clean_tables, clean_templates, clean_headings, clean_links)


def cleaned(df: DataFrame, text: str = "text", into: str = "clean") -> DataFrame:
    """All steps in their order; null becomes the empty text."""
    df = df.withColumn(into, F.coalesce(F.col(text), F.lit("")))
    for step in STEPS:
        df = df.withColumn(into, step(F.col(into)))
    return df


PART = "array<struct<part_no:int,surface:string,title:string>>"


def parts_of(text: Column) -> Column:
    """The parts of a cleaned text, in an array of (part_no, surface, title).

    Text between links (title '') and links, alternating from 0 on. A link's
    title is what stands before the pipe, else its surface, with `_` for blanks
    and without its anchor. A text has at least one part.
    """
    gaps = F.transform(F.split(text, LINK, -1), lambda x, i: F.struct((i * 2).alias("part_no"), x.alias("surface"), F.lit("").alias("title")))
    before, shown = F.regexp_extract_all(text, F.lit(LINK), F.lit(1)), F.regexp_extract_all(text, F.lit(LINK), F.lit(2))
    links = F.zip_with(before, shown, lambda b, x: F.struct(x.alias("surface"), s.without_anchor(s.underscored(F.when(b != "", b).otherwise(x))).alias("title")))
    links = F.transform(links, lambda x, i: F.struct((i * 2 + 1).alias("part_no"), x["surface"].alias("surface"), x["title"].alias("title")))
    return F.array_sort(F.concat(gaps, links)).cast(PART)


def link_parts(df: DataFrame, keys: list[str], text: str = "clean") -> DataFrame:
    """keys, part_no, surface, title: one row a part of parts_of."""
    return df.select(*keys, F.explode(parts_of(F.col(text))).alias("_x")).select(*keys, "_x.*")


def known_titles(titles: DataFrame, entities: DataFrame, redirects: DataFrame) -> DataFrame:
    """title, page_title, type of distinct titles: an entity's own type, else that of the redirect's target, else O.

    entities(page_title, ent_type) and redirects(rd_from_title, rd_title,
    ent_type) have one row a title.
    """
    ent = entities.select(F.col("page_title").alias("title"), F.col("ent_type").alias("own_type"))
    red = redirects.select(F.col("rd_from_title").alias("title"), F.col("rd_title").alias("target"), F.col("ent_type").alias("target_type"))
    names = titles.join(ent, "title", "left").join(red, "title", "left")
    hit = F.col("own_type").isNotNull()
    return names.select("title", F.when(~hit & F.col("target").isNotNull(), F.col("target")).otherwise(F.col("title")).alias("page_title"), F.coalesce("own_type", "target_type", F.lit("O")).alias("type"))


def parted(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """keys, the other columns but the text, parts and titles of each document, cleaned and cut once and written."""
    rows = cleaned(docs, text, "_clean").withColumn("parts", parts_of(F.col("_clean"))).drop(text, "_clean")
    own = F.filter(F.array_distinct(F.transform("parts", lambda x: x["title"])), lambda x: x != "")
    return materialize(rows.withColumn("titles", own), "parts")


def resolved_documents(parts: DataFrame, keys: list[str], entities: DataFrame, redirects: DataFrame) -> DataFrame:
    """parted documents, one a key, whose parts are (part_no, surface, page_title, type).

    Only a document's distinct titles leave it: they are looked up, hot ones
    salted, and come back as one map a document. Its text is shuffled once,
    by its key, however many links or tokens it has.
    """
    links = parts.select(*keys, F.explode("titles").alias("title")).distinct()
    links = materialize(links, "links", n=F.lit(1))
    known = known_titles(links.select("title").distinct(), entities, redirects)
    found = skew_lookup(links, known, ["title"], "inner", rows=written_sums(links)["n"])
    found = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("title", F.struct("page_title", "type")))).alias("found"))
    docs = parts.drop("titles").dropDuplicates(keys).join(found, keys, "left")
    solve = lambda x, got: F.struct(x["part_no"].alias("part_no"), x["surface"].alias("surface"), F.coalesce(got["page_title"], F.lit("")).alias("page_title"), F.coalesce(got["type"], F.lit("O")).alias("type"))
    solved = F.transform("parts", lambda x: _given(F.col("found")[x["title"]], lambda got: solve(x, got)))
    return docs.withColumn("parts", solved).drop("found")


def resolved_parts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part_no, surface, page_title, type: one row a part of resolved documents."""
    return docs.select(*keys, F.explode("parts").alias("_x")).select(*keys, "_x.*")


def tokens(parts: Column) -> Column:
    """An array of (part_no, tok_no, word, page_title, tag): tokens never cross parts.

    B- stands on the first token of each sentence within a link, so on the
    first of a part and on those after `.`, `!` and `?`.
    """

    def of_part(x: Column) -> Column:
        def tagged(words: Column) -> Column:
            tag = lambda i: F.when(x["type"] == "O", "O").otherwise(F.concat(F.when((i == 0) | F.get(words, i - 1).isin(*ENDS), "B-").otherwise("I-"), x["type"]))
            return F.transform(words, lambda w, i: F.struct(x["part_no"].alias("part_no"), i.alias("tok_no"), w.alias("word"), x["page_title"].alias("page_title"), tag(i).alias("tag")))

        return _given(F.regexp_extract_all(x["surface"], F.lit(TOKEN), F.lit(0)), tagged)

    return F.flatten(F.transform(parts, of_part))


def tokens_of(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, part_no, tok_no, word, page_title, tag: one row a token of resolved documents."""
    return docs.select(*keys, F.explode(tokens(F.col("parts"))).alias("_x")).select(*keys, "_x.*")


def _given(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sentences(flat: Column) -> Column:
    end = F.size(flat) - 1
    ends = F.filter(F.transform(flat, lambda x, i: F.when(x["word"].isin(*ENDS) | (i == end), i + 1)), lambda x: x.isNotNull())
    starts = lambda e: F.concat(F.array(F.lit(0)), F.slice(e, F.lit(1), F.greatest(F.size(e) - 1, F.lit(0))))
    none = F.array().cast("array<array<struct<word:string,tag:string,page_title:string>>>")
    cut = _given(ends, lambda e: F.zip_with(starts(e), e, lambda a, b: F.slice(flat, a + 1, b - a)))
    return F.when(F.size(flat) > 0, cut).otherwise(none)


def with_sentences(docs: DataFrame) -> DataFrame:
    """Resolved documents with sentences: an array of arrays of (word, tag, page_title), cut after `.`, `!` and `?`."""
    flat = F.transform(tokens(F.col("parts")), lambda x: F.struct(x["word"].alias("word"), x["tag"].alias("tag"), x["page_title"].alias("page_title")))
    return docs.withColumn("sentences", _given(flat, _sentences)).drop("parts")


def sentences_of(docs: DataFrame, keys: list[str]) -> DataFrame:
    """keys, sentence, token, word, tag, page_title: 0-based numbers of sentence and token."""
    rows = with_sentences(docs).select(*keys, F.posexplode("sentences").alias("sentence", "_s"))
    return rows.select(*keys, "sentence", F.posexplode("_s").alias("token", "_t")).select(*keys, "sentence", "token", "_t.*")


def _lists(docs: DataFrame) -> DataFrame:
    pick = lambda field: F.transform("sentences", lambda snt: F.transform(snt, lambda x: x[field]))
    return with_sentences(docs).select("page_id", "page_title", pick("word").alias("text"), pick("tag").alias("tags"), pick("page_title").alias("link_titles"))


def tagged_documents(text: DataFrame, page: DataFrame, entities: DataFrame, redirects: DataFrame, numbers: dict[str, int] | None = None) -> DataFrame:
    """page_id, page_title, text, tags, link_titles (lists of lists) of every article of namespace 0.

    Articles without tokens have empty lists; repeated rows of an article count
    once. numbers, if given, takes how many rows are tagged and how many
    redirects there are.
    """
    own = page.where("page_namespace = 0").select("page_id").distinct()
    keys = ["page_id", "doc_key"]
    docs = text.select("page_id", F.col("title").alias("page_title"), "text").withColumn("doc_key", F.xxhash64("page_id", "text")).join(own, "page_id", "left_semi")
    parts = parted(docs, keys)
    if numbers is not None:
        redirects = materialize(redirects, "redirects", n=F.lit(1))
        numbers |= {"n_redirects": written_sums(redirects)["n"], "n_pages": parts.select(*keys).distinct().count()}
    return _lists(resolved_documents(parts, keys, entities, redirects))


def tagged_page(page_id: int, title: str, text: str | None, entities: DataFrame, redirects: DataFrame) -> DataFrame:
    """The row of tagged_documents for one text at hand, whatever its name space."""
    docs = entities.sparkSession.createDataFrame([(page_id, title, text, 0)], "page_id long, page_title string, text string, doc_key long")
    keys = ["page_id", "doc_key"]
    return _lists(resolved_documents(parted(docs, keys), keys, entities, redirects))


def as_json(tagged: DataFrame) -> DataFrame:
    """The stored form: the three lists as JSON."""
    return tagged.select("page_id", *[F.to_json(c).alias(c) for c in ("text", "tags", "link_titles")], "page_title")
