"""Queries and SQL of the problems on text and records for training data."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.llm import garbled, lookalike, markup, mixing, packing, sentences, survivor, tokens
from tesserae.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.alike_pairs(table(spark, d, "entities"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.one_form_titles(table(spark, d, "entities"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.form_groups(table(spark, d, "entities"))


def _sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "text"), table(spark, d, "tagged"), table(spark, d, "page"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _sentences(spark, d).select("src", "page_id", "unit_start")


def p2_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of every article, marked up or not, with their ends."""
    return sentences.text_units(table(spark, d, "text"), table(spark, d, "page"), plain_only=False)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.markup_elements(table(spark, d, "text"))


def p3_clean(spark: SparkSession, d: str) -> DataFrame:
    return markup.cleaned_texts(table(spark, d, "text"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.clear_winners(table(spark, d, "entities"), table(spark, d, "class_trust"))


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.best_records(table(spark, d, "entities"), table(spark, d, "class_trust"))


def _packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.with_tokens(table(spark, d, "documents"), ["doc_id"]).select("doc_id", "tokens"), table(spark, d, "container_spec"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(_packed(spark, d), table(spark, d, "container_spec"))


def _mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.select(tokens.with_tokens(table(spark, d, "documents"), ["doc_id", "source"]), table(spark, d, "mix_target"))


def p8_selection(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(_mixed(spark, d), table(spark, d, "mix_target"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return garbled.garbled_documents(table(spark, d, "documents"))


def p9_restored(spark: SparkSession, d: str) -> DataFrame:
    return garbled.restore(table(spark, d, "documents"))


QUERIES = {"p1_found": p1_found, "p1_forms": p1_forms, "p1_groups": p1_groups, "p2_found": p2_found, "p2_units": p2_units, "p3_found": p3_found, "p3_clean": p3_clean, "p5_found": p5_found, "p5_records": p5_records, "p7_containers": p7_containers, "p7_fill": p7_fill, "p8_selection": p8_selection, "p8_shares": p8_shares, "p9_found": p9_found, "p9_restored": p9_restored}

_ROWS = r"""
rows AS (SELECT 'Q' || regexp_extract(translate(wikidata, '０１２３４５６７８９Ｑｑ', '0123456789Qq'), '(?:^|[^A-Za-z0-9])[Qq]0*([0-9]+)(?:$|[^0-9A-Za-z])', 1) AS qid, ent_id, modified_at,
  coalesce(trust_rank, 1073741824) AS trust,
  dateofbirth IS NOT NULL AS b, inception IS NOT NULL AS i,
  coalesce(abs(TRY_CAST(regexp_extract(trim(coords), '^Point\(\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s+([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*\)$', 1) AS DOUBLE)) <= 180
    AND abs(TRY_CAST(regexp_extract(trim(coords), '^Point\(\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s+([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*\)$', 2) AS DOUBLE)) <= 90, false) AS c
  FROM entities LEFT JOIN (SELECT src_class, min(trust_rank) AS trust_rank FROM class_trust GROUP BY 1) USING (src_class) WHERE wikidata IS NOT NULL),
item AS (SELECT qid, count(*) AS n, bool_or(b) AS b, bool_or(i) AS i, bool_or(c) AS c FROM rows WHERE qid <> 'Q' GROUP BY qid)
"""



# Letters and the Latin letters that they look like, one below the other, by script.
LOOKS = (
    ("аеіјорсухѕһԁԛԝӏАВЕІЈКМНОРСТУХЅԚԜҮѵүѴӀԌ", "aeijopcyxshdqwlABEIJKMHOPCTYXSQWYvyVIG"),
    ("ονΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϹϳρͿ", "ovABEZHIKMNOPTYXcCjpJ"),
    ("ɡɑıօսոհցյզՕՏՍԼᴄᴏꜱᴜᴠᴡᴢ", "gaiounhgjqOSULcosuvwz"),
    ("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏂᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏧᏴ", "DRTiAJEWMHyGhZbRWSVSLCPKdB"),
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU"),
    ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥⲭ", "BHIKMNOPCTYXopcx"),
    ("\u2010\u2011", "--"),
)


def _plain_sql(value: str) -> str:
    """The one form in DuckDB, which knows neither the operator's table nor its composition: characters replaced one by one, then composed; made from the Unicode database by rule."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    looks = {a: b for row in LOOKS for a, b in zip(*row, strict=True)}
    old, new, gone, long = "", "", "", {}
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or 0x3400 <= cp <= 0x9FFF or cp > 0x2FA1F or unicodedata.category(ch) == "Cn":
            continue
        kind = unicodedata.decomposition(ch).split(" ")[0]
        bare = unicodedata.normalize("NFD", ch)
        under = "".join(looks.get(x, x) for x in bare)  # the letter below the marks
        to = unicodedata.normalize("NFC", under) if kind and not kind.startswith("<") and under != bare else unicodedata.normalize("NFKD", ch) if kind in lookalike.SAME_LOOK else looks.get(ch, ch)
        if unicodedata.category(ch) in ("Cf", "Cc") or ch in lookalike.SHAPELESS or 0xFE00 <= cp <= 0xFE0F:
            gone += ch
        elif unicodedata.category(ch) in ("Zs", "Zl", "Zp"):
            old, new = old + ch, new + "_"
        elif len(to) == 1 and to != ch:
            old, new = old + ch, new + looks.get(to, to)
        elif 1 < len(to) < 6 and to.isascii() and not to.startswith(" "):
            long[ch] = to
    for ch, to in long.items():
        value = f"replace({value}, {quoted(ch)}, {quoted(to)})" if 0x2160 <= ord(ch) <= 0x217F or 0xFB00 <= ord(ch) <= 0xFB06 else value
    return f"nfc_normalize(translate(replace({value}, ' ', '_'), {quoted(old + gone)}, {quoted(new)}))"


_VALUES = f"""
vals AS (SELECT 'page_title' AS field_name, ent_id, '' AS site, page_title AS value FROM entities WHERE page_title IS NOT NULL
  UNION ALL SELECT 'sitelink', ent_id, sitelink[1:strpos(sitelink, '/wiki/') - 1], url_decode(sitelink[strpos(sitelink, '/wiki/') + 6:]) FROM entities WHERE strpos(sitelink, '/wiki/') > 0),
forms AS (SELECT *, {_plain_sql('value')} AS form FROM vals)
"""

SQL = {
    "p1_found": f"WITH {_VALUES} SELECT DISTINCT a.field_name, a.ent_id AS ent_a, b.ent_id AS ent_b FROM forms a JOIN forms b USING (field_name, site, form) WHERE a.ent_id < b.ent_id AND a.value <> b.value AND form <> ''",
    "p1_forms": f"WITH {_VALUES} SELECT field_name, ent_id, site, value, form FROM forms",
    "p1_groups": f"WITH {_VALUES} SELECT field_name, site, form, count(DISTINCT value) AS n_writings, count(*) AS n_rows FROM forms GROUP BY ALL",
    "p5_found": f"""WITH {_ROWS}
SELECT r.qid, r.ent_id FROM rows r JOIN item t USING (qid)
WHERE t.n >= 2 AND (t.b OR t.i OR t.c) AND r.b = t.b AND r.i = t.i AND r.c = t.c
  AND NOT EXISTS (SELECT 1 FROM rows o WHERE o.qid = r.qid AND o.ent_id <> r.ent_id AND NOT coalesce((o.modified_at < r.modified_at OR (o.modified_at IS NULL AND r.modified_at IS NOT NULL)) AND o.trust > r.trust, false))""",
}
