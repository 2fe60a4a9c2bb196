"""SQL for DuckDB of the knowledge-base queries."""

from __future__ import annotations

from tesserae.operators import triples as tr, wikitext as w
from tesserae.operators.entity_table import VALUES, consumed
from tesserae.plans.reference import OTHER, PAGE_PROPS, ROLES, SITE, TRIPLES, WORKS


def plain(text: str) -> str:
    for n in ("page", "entities", "categorylinks", "redirect", "tagged", "text"):
        text = text.replace("{" + n + "}", n)
    return text


def quoted(p: str) -> str:
    return "'" + p.replace("(?d)", "").replace("'", "''") + "'"


def sub(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, {quoted(pattern)}, '{to}', 'g')"


def repeated(expr: str, pattern: str, times: int = 8) -> str:
    for _ in range(times):
        expr = sub(expr, pattern, "")
    return expr


TABLE = r"(?s)\{\|(?:[^{]|\{+[^|{])*?\|\}"  # the same language without a lookahead


def _links(e: str) -> str:
    e = sub(e, w.PROTECT, r"{|\1\2\3|}")
    e = sub(sub(e, w.FILE_LINK, ""), w.WEB_LINK, "")
    return sub(e, w.RESTORE, r"[[\1\2\3]]")


STEPS = {
    "clean_references": lambda e: sub(sub(e, w.REFERENCES, ""), w.FILMS, ""),
    "clean_comments": lambda e: sub(e, w.COMMENT, " "),
    "clean_tags": lambda e: sub(sub(e, w.SINGLE_TAG, " "), w.PAIRED_TAG, " "),
    "clean_tables": lambda e: repeated(e, TABLE),
    "clean_templates": lambda e: repeated(e, w.TEMPLATE),
    "clean_headings": lambda e: f"replace({sub(e, w.HEADING, ' ')}, '&nbsp;', ' ')",
    "clean_links": _links,
}
DOCS = "docs AS (SELECT DISTINCT page_id, md5(text) AS doc_key, text FROM text WHERE text IS NOT NULL)"
CLEAN, at = DOCS, "docs"
for _i, (_name, _f) in enumerate(STEPS.items()):
    CLEAN += f",\ns{_i} AS (SELECT page_id, doc_key, {_f('text')} AS text FROM {at})"
    at = f"s{_i}"
CLEAN += f",\nclean AS (SELECT page_id, doc_key, text AS clean FROM {at})"

ENT = "ent AS (SELECT page_title, arg_min(ent_type, ent_id) AS ent_type FROM entities WHERE page_title IS NOT NULL AND ent_type IS NOT NULL GROUP BY page_title)"
ART = "art AS (SELECT DISTINCT page_id, page_title FROM page WHERE page_namespace = 0)"
RED = f"""{ENT}, {ART},
red AS (SELECT rd_from_title, rd_title, ent_type FROM (SELECT a.page_title AS rd_from_title, r.rd_title, e.ent_type, row_number() OVER (PARTITION BY a.page_title ORDER BY r.rd_title, a.page_id) AS n
  FROM redirect r JOIN art a ON a.page_id = r.rd_from JOIN ent e ON e.page_title = r.rd_title) x WHERE n = 1)"""
PARTS = f"""{CLEAN},
cut AS (SELECT page_id, doc_key, string_split_regex(clean, {quoted(w.LINK)}) AS gaps, regexp_extract_all(clean, {quoted(w.LINK)}, 1) AS b, regexp_extract_all(clean, {quoted(w.LINK)}, 2) AS s FROM clean),
parts AS (SELECT page_id, doc_key, 2 * (i - 1) AS part_no, gaps[i] AS surface, '' AS title FROM (SELECT *, unnest(range(1, len(gaps) + 1)) AS i FROM cut) x
  UNION ALL SELECT page_id, doc_key, 2 * i - 1, s[i], regexp_extract(replace(CASE WHEN b[i] <> '' THEN b[i] ELSE s[i] END, ' ', '_'), '^#?([^#]*)', 1) FROM (SELECT *, unnest(range(1, len(s) + 1)) AS i FROM cut) x)"""
SOLVED = f"""{PARTS}, {RED},
solved AS (SELECT p.page_id, p.doc_key, p.part_no, p.surface,
  CASE WHEN p.title = '' THEN '' WHEN e.page_title IS NULL AND r.rd_title IS NOT NULL THEN r.rd_title ELSE p.title END AS page_title,
  CASE WHEN p.title = '' THEN 'O' ELSE coalesce(e.ent_type, r.ent_type, 'O') END AS type
  FROM parts p LEFT JOIN ent e ON p.title <> '' AND e.page_title = p.title LEFT JOIN red r ON p.title <> '' AND r.rd_from_title = p.title)"""
TOKENS = f"""{SOLVED},
words AS (SELECT *, regexp_extract_all(surface, {quoted(w.TOKEN)}) AS ws FROM solved),
toks AS (SELECT page_id, doc_key, part_no, page_title, CAST(i - 1 AS INTEGER) AS tok_no, ws[i] AS word, CASE WHEN type = 'O' THEN 'O' WHEN i = 1 OR ws[i - 1] IN ('.', '!', '?') THEN 'B-' || type ELSE 'I-' || type END AS tag
  FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM words) x)"""
SENTENCES = f"""{TOKENS},
numbered AS (SELECT *, coalesce(sum(CASE WHEN word IN ('.', '!', '?') THEN 1 ELSE 0 END) OVER (PARTITION BY page_id, doc_key ORDER BY part_no, tok_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM toks),
sent AS (SELECT page_id, doc_key, CAST(sentence AS INTEGER) AS sentence, CAST(row_number() OVER (PARTITION BY page_id, doc_key, sentence ORDER BY part_no, tok_no) - 1 AS INTEGER) AS token, word, tag, page_title FROM numbered)"""

CATS = f"""roles AS ({plain(ROLES)}),
cats AS (SELECT DISTINCT page_id, page_title FROM page WHERE page_namespace = 14),
members AS (SELECT c.cl_to, c.cl_from, p.page_id, p.page_title FROM categorylinks c LEFT JOIN cats p ON p.page_id = c.cl_from),
reach AS (SELECT root, root AS node FROM roles UNION SELECT r.root, m.page_title FROM reach r JOIN members m ON m.cl_to = r.node WHERE m.page_title IS NOT NULL),
found AS (SELECT DISTINCT r.root, a.page_id, a.page_title FROM reach r JOIN members m ON m.cl_to = r.node JOIN (SELECT DISTINCT page_id, page_title FROM page WHERE page_namespace = 0) a ON a.page_id = m.cl_from
  WHERE a.page_title IS NOT NULL AND NOT starts_with(a.page_title, 'Liste_'))"""

CLASS = f"""triples AS ({plain(TRIPLES)}),
sub AS (SELECT root, root AS node FROM (VALUES {', '.join(f"('{e.root}')" for e in tr.EXTRACTS)}) v(root) UNION SELECT s.root, t.subj FROM sub s JOIN triples t ON t.pred = 'P279' AND t.obj = s.node),
inst AS (SELECT s.root, t.subj FROM sub s JOIN triples t ON t.pred = 'P31' AND t.obj = s.node)"""


def extract(name: str) -> str:
    e = tr.BY_NAME[name]
    joins = "".join(f" LEFT JOIN triples t{i} ON t{i}.pred = '{tr.PROPERTIES[p]}' AND t{i}.subj = i.subj" for i, p in enumerate((*e.matched, *e.optional)))
    cols = "".join(f", t{i + len(e.matched)}.obj AS {p}" for i, p in enumerate(e.optional))
    return f"WITH RECURSIVE {CLASS} SELECT i.subj AS {e.variable}, l.obj AS label, a.subj AS sitelink{cols} FROM inst i JOIN triples l ON l.pred = 'label' AND l.obj_lang = 'de' AND l.subj = i.subj JOIN triples a ON a.pred = 'about' AND a.obj = i.subj AND contains(a.subj, '{SITE}'){joins} WHERE i.root = '{e.root}'"


SETS = f"""works AS ({plain(WORKS)}),
orders AS (SELECT * FROM (VALUES {', '.join(f"('{n}', {t}, {c})" for n, t, c in consumed())}) v(src_class, type_ord, class_ord)),
sets AS (SELECT * FROM (SELECT o.type_ord, e.wikidata, {', '.join('e.' + v for v in VALUES)}, e.src_class, e.ent_id AS row_ord, row_number() OVER (PARTITION BY o.type_ord, e.wikidata ORDER BY o.class_ord, e.ent_id) AS n
  FROM entities e JOIN orders o USING (src_class) WHERE contains(e.sitelink, '{SITE}') AND e.wikidata IS NOT NULL) x WHERE n = 1 AND wikidata NOT IN (SELECT wikidata FROM works)),
merged AS (SELECT wikidata, {', '.join(f'arg_min({v}, type_ord) FILTER (WHERE {v} IS NOT NULL) AS {v}' for v in VALUES)}, bool_or(type_ord = 0) AS per, bool_or(type_ord = 1) AS loc, bool_or(type_ord = 2) AS org FROM sets GROUP BY wikidata),
flagged AS (SELECT *, per AND NOT org AS is_per, loc AS is_loc, org AS is_org, concat_ws('|', CASE WHEN per AND NOT org THEN 'PER' END, CASE WHEN loc THEN 'LOC' END, CASE WHEN org THEN 'ORG' END) AS ent_type FROM merged)"""


def point(i: int, strict: bool = False) -> str:
    dot = "" if strict else "."
    return rf"nullif(regexp_extract(coords, 'Point\(([\-0-9E.]+)\W{dot}([\-0-9E.]+)\)', {i}), '')"


PAYLOAD = """lists AS (SELECT DISTINCT page_id, page_title, loaded_at, text, tags, link_titles, CAST(CAST(text AS JSON) AS VARCHAR[][]) AS w, CAST(CAST(tags AS JSON) AS VARCHAR[][]) AS p, CAST(CAST(link_titles AS JSON) AS VARCHAR[][]) AS g FROM tagged),
snt AS (SELECT page_id, i, w[i] AS w, p[i] AS p, g[i] AS g FROM (SELECT *, unnest(range(1, least(len(w), len(p), len(g)) + 1)) AS i FROM lists) x),
payload AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS sentence, CAST(j - 1 AS INTEGER) AS token, w[j] AS word, p[j] AS prediction, g[j] AS gt FROM (SELECT *, unnest(range(1, least(len(w), len(p), len(g)) + 1)) AS j FROM snt) x),
parsed AS (SELECT page_id, CAST(page_id AS VARCHAR) AS page_title, entity_id, gt FROM (SELECT page_id, word || '-' || prediction[3:] AS entity_id, gt, row_number() OVER (PARTITION BY page_id, word || '-' || prediction[3:] ORDER BY sentence, token, gt) AS n FROM payload WHERE prediction LIKE 'B-%') x WHERE n = 1)"""

MAPPING = f"""{ENT}, props AS ({plain(PAGE_PROPS)}),
de AS (SELECT a.page_title AS de, p.pp_value AS qid FROM (SELECT DISTINCT page_id, page_title FROM page WHERE page_namespace = 0) a JOIN props p ON p.pp_page = a.page_id AND p.pp_propname = 'wikibase_item'),
fr AS ({plain(OTHER.replace('{lang}', 'fr').replace('{part}', '3').replace('{twice}', '11'))}),
en AS ({plain(OTHER.replace('{lang}', 'en').replace('{part}', '4').replace('{twice}', '13'))}),
mapping AS (SELECT d.qid, e.ent_type, d.de, f.page_title AS fr, n.page_title AS en FROM ent e JOIN de d ON d.de = e.page_title LEFT JOIN fr f USING (qid) LEFT JOIN en n USING (qid))"""

POOL = "pool AS (SELECT DISTINCT page_id, page_title FROM page WHERE page_namespace = 0 AND NOT starts_with(page_title, 'Liste_') AND NOT ends_with(page_title, 'Begriffsklärung)'))"
LINKS = "links AS (SELECT page_id, unnest(flatten(CAST(CAST(link_titles AS JSON) AS VARCHAR[][]))) AS target FROM tagged)"
JOINED = "string_agg(l, chr(10) ORDER BY sentence)"

SQL = {
    "apriori_probs": f"WITH {LINKS}, n AS (SELECT target, count(*) AS c FROM links WHERE target <> '' GROUP BY 1) SELECT e.page_title, coalesce(n.c, 0) AS n_links, CAST(coalesce(n.c, 0) AS DOUBLE) / (SELECT sum(c) FROM n) AS proba FROM (SELECT DISTINCT page_title FROM entities WHERE page_title IS NOT NULL) e LEFT JOIN n ON n.target = e.page_title",
    "ns0_articles": f"WITH {POOL} SELECT * FROM pool",
    "category_members": f"WITH RECURSIVE {CATS} SELECT * FROM members",
    "category_closure": f"WITH RECURSIVE {CATS} SELECT * FROM reach",
    "category_member_rows": f"WITH RECURSIVE {CATS} SELECT DISTINCT r.root, m.cl_from, m.page_id, m.page_title FROM reach r JOIN members m ON m.cl_to = r.node",
    "category_pages": f"WITH RECURSIVE {CATS} SELECT * FROM found",
    "typed_entities": f"""WITH RECURSIVE {CATS}, part AS (SELECT DISTINCT role, page_id, page_title FROM found JOIN roles USING (root)), ids AS (SELECT role, page_id FROM part)
SELECT page_id, page_title, 'PER' AS ent_type FROM (SELECT DISTINCT page_id, page_title FROM part WHERE role = 'per') a
UNION ALL SELECT page_id, page_title, 'LOC' FROM part p WHERE role = 'geo' AND NOT EXISTS (SELECT 1 FROM ids i WHERE i.page_id = p.page_id AND i.role IN ('per', 'notion'))
UNION ALL SELECT page_id, page_title, 'ORG' FROM part p WHERE role = 'org' AND NOT EXISTS (SELECT 1 FROM ids i WHERE i.page_id = p.page_id AND i.role IN ('per', 'geo'))""",
    "disambiguation_pages": f"WITH RECURSIVE {CATS} SELECT page_id, page_title FROM found WHERE root = (SELECT root FROM roles WHERE role = 'notion')",
    "redirect_sources": f"WITH {RED} SELECT * FROM red",
    "redirect_duplicates": f"WITH {ART} SELECT count(*) AS n_rows, count(DISTINCT page_title) AS n_titles, count(*) - count(DISTINCT page_title) AS n_duplicates FROM redirect r JOIN art a ON a.page_id = r.rd_from",
    "redirects_to_entities": f"WITH {RED} SELECT * FROM ent e WHERE NOT EXISTS (SELECT 1 FROM red WHERE rd_from_title = e.page_title)",
    "qid_pages": f"WITH {MAPPING} SELECT de AS page_title, qid FROM de",
    "qid_mapping": f"WITH {MAPPING} SELECT * FROM mapping",
    "lang_entities": f"WITH {MAPPING} SELECT page_title, ent_type FROM (SELECT fr AS page_title, ent_type, row_number() OVER (PARTITION BY fr ORDER BY qid, ent_type) AS n FROM mapping WHERE fr IS NOT NULL AND ent_type IS NOT NULL) x WHERE n = 1",
    "instance_of_closure": f"WITH RECURSIVE {CLASS} SELECT * FROM inst",
    "class_extract_person": extract("subject"),
    "class_extract_location": extract("geographic-entity"),
    "class_extract_organisation": extract("institution"),
    "class_extract_person_undated": extract("person"),
    **{"class_extract_" + e.name.replace("-", "_"): extract(e.name) for e in tr.EXTRACTS if e.name not in ("subject", "geographic-entity", "institution", "person", "work-of-arts")},
    "works_exclusion": f"WITH RECURSIVE {CLASS} SELECT subj AS woa FROM inst WHERE root = 'Q838948'",
    "type_sets": f"WITH {SETS} SELECT type_ord, wikidata, src_class, row_ord, label FROM sets",
    "entity_first_nonnull": f"WITH {SETS} SELECT wikidata, {', '.join(VALUES)} FROM merged",
    "entity_coords": f"SELECT ent_id, coords, {point(1)} AS longitude, {point(2)} AS latitude, {point(1, True)} AS longitude_strict, {point(2, True)} AS latitude_strict FROM entities",
    "entity_title": f"SELECT ent_id, url_decode(replace(sitelink, '{SITE}', '')) AS title FROM entities",
    "entity_dates": "SELECT ent_id, TRY_CAST(CASE WHEN ent_id % 7 = 0 THEN 't' || ent_id ELSE CAST(coalesce(dateofbirth, inception) AS VARCHAR) END AS TIMESTAMP) AS parsed FROM entities",
    "entity_qid": "SELECT ent_id, nullif(regexp_extract(wikidata, '(Q[0-9]+)', 1), '') AS item FROM entities",
    "entity_flags_type": f"WITH {SETS} SELECT wikidata, is_per, is_loc, is_org, ent_type FROM flagged",
    "entity_table": f"""WITH {SETS} SELECT page_title, wikidata, {', '.join(VALUES)}, longitude, latitude, is_per, is_loc, is_org, ent_type, qid FROM (SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY dateofbirth NULLS LAST, inception NULLS LAST, wikidata) AS n FROM (
SELECT url_decode(replace(sitelink, '{SITE}', '')) AS page_title, wikidata, {', '.join(VALUES)}, {point(1)} AS longitude, {point(2)} AS latitude, is_per, is_loc, is_org, ent_type, nullif(regexp_extract(wikidata, '(Q[0-9]+)', 1), '') AS qid FROM flagged) x) y WHERE n = 1""",
    **{name: f"WITH {DOCS} SELECT page_id, doc_key, {f('text')} AS clean FROM docs" for name, f in STEPS.items()},
    "clean_text": f"WITH {CLEAN} SELECT * FROM clean",
    "link_parts": f"WITH {PARTS} SELECT page_id, doc_key, CAST(part_no AS INTEGER) AS part_no, surface, title FROM parts",
    "link_resolution": f"WITH {SOLVED} SELECT page_id, doc_key, CAST(part_no AS INTEGER) AS part_no, surface, page_title, type FROM solved",
    "tokens_bio": f"WITH {TOKENS} SELECT page_id, doc_key, CAST(part_no AS INTEGER) AS part_no, tok_no, word, page_title, tag FROM toks",
    "sentences": f"WITH {SENTENCES} SELECT * FROM sent",
    "tagged_documents": f"""WITH {SENTENCES},
lines AS (SELECT page_id, doc_key, sentence, string_agg(word, ' ' ORDER BY token) AS a, string_agg(tag, ' ' ORDER BY token) AS b, string_agg(page_title, ' ' ORDER BY token) AS c FROM sent GROUP BY ALL),
made AS (SELECT page_id, doc_key, {JOINED.replace('l,', 'a,')} AS text, {JOINED.replace('l,', 'b,')} AS tags, {JOINED.replace('l,', 'c,')} AS link_titles FROM lines GROUP BY ALL),
own AS (SELECT DISTINCT page_id, title, text FROM text WHERE page_id IN (SELECT page_id FROM page WHERE page_namespace = 0))
SELECT o.page_id, o.title AS page_title, coalesce(m.text, '') AS text, coalesce(m.tags, '') AS tags, coalesce(m.link_titles, '') AS link_titles FROM own o LEFT JOIN made m ON m.page_id = o.page_id AND m.doc_key = md5(o.text)""",
    "train_dev_test": f"""WITH {POOL}, r AS (SELECT *, row_number() OVER (ORDER BY md5('41:' || page_id), page_id) - 1 AS k, CAST((SELECT count(*) FROM pool) AS DOUBLE) AS n FROM pool),
b AS (SELECT *, CAST(floor(CAST(0.6 AS DOUBLE) * n) AS BIGINT) AS x, CAST(floor(CAST(0.2 AS DOUBLE) * n) AS BIGINT) AS y, CAST(floor(CAST(0.15 AS DOUBLE) * n) AS BIGINT) AS z FROM r)
SELECT page_id, page_title, CASE WHEN k < x THEN 'train' WHEN k < x + y THEN 'dev' ELSE 'test' END AS part FROM b WHERE k < x + y + z""",
    "xml_pages": r"SELECT page_id, title, md5(trim(regexp_replace(coalesce(text, ''), '[ \t\n]+', ' ', 'g'), ' ')) AS digest FROM (SELECT DISTINCT page_id, title, regexp_replace(text, '[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]', ' ', 'g') AS text FROM text WHERE text IS NOT NULL) x",
    "insert_dump": "SELECT page_id, CAST(page_namespace AS BIGINT) AS page_namespace, page_title, page_lang FROM page",
    "sqlite_tables": "SELECT rd_from, CAST(rd_namespace AS BIGINT) AS rd_namespace, rd_title FROM redirect",
    "page_ranges": "SELECT CAST(floor(page_id / 10000) AS BIGINT) AS page_range, count(*) AS n_pages, min(page_id) AS first_id, max(page_id) AS last_id FROM text WHERE page_id IS NOT NULL GROUP BY 1",
    "replaced_table": f"WITH {LINKS} SELECT page_title, n_links FROM (SELECT DISTINCT page_title FROM entities WHERE page_title IS NOT NULL) e JOIN (SELECT target AS page_title, count(*) AS n_links FROM links WHERE target <> '' GROUP BY 1) n USING (page_title)",
    "language_tables": f"WITH {MAPPING}, long AS (SELECT 'de' AS lang, de AS page_title, qid, ent_type FROM mapping UNION ALL SELECT 'fr', fr, qid, ent_type FROM mapping UNION ALL SELECT 'en', en, qid, ent_type FROM mapping) SELECT lang, page_title, ent_type FROM (SELECT *, row_number() OVER (PARTITION BY lang, page_title ORDER BY qid, ent_type) AS n FROM long WHERE page_title IS NOT NULL AND ent_type IS NOT NULL) x WHERE n = 1",
    "sparql_results": "SELECT src_class AS class, CAST(trust_rank AS VARCHAR) AS rank FROM class_trust",
    "tagged_json": f"""WITH {SENTENCES},
lines AS (SELECT page_id, doc_key, sentence, list(word ORDER BY token) AS a, list(tag ORDER BY token) AS b, list(page_title ORDER BY token) AS c FROM sent GROUP BY ALL),
made AS (SELECT page_id, doc_key, to_json(list(a ORDER BY sentence)) AS text, to_json(list(b ORDER BY sentence)) AS tags, to_json(list(c ORDER BY sentence)) AS link_titles FROM lines GROUP BY ALL),
own AS (SELECT DISTINCT page_id, title, text FROM text WHERE page_id IN (SELECT page_id FROM page WHERE page_namespace = 0))
SELECT o.page_id, o.title AS page_title, coalesce(CAST(m.text AS VARCHAR), '[]') AS text, coalesce(CAST(m.tags AS VARCHAR), '[]') AS tags, coalesce(CAST(m.link_titles AS VARCHAR), '[]') AS link_titles FROM own o LEFT JOIN made m ON m.page_id = o.page_id AND m.doc_key = md5(o.text)""",
    "tagging_numbers": f"WITH {RED} SELECT (SELECT count(*) FROM (SELECT DISTINCT page_id, text FROM text WHERE page_id IN (SELECT page_id FROM page WHERE page_namespace = 0))) AS n_pages, (SELECT count(*) FROM red) AS n_redirects",
    "tagged_page": f"""WITH {SENTENCES},
first AS (SELECT page_id, title, md5(text) AS doc_key FROM text WHERE page_id IS NOT NULL AND text IS NOT NULL ORDER BY page_id, md5(text), title LIMIT 1),
lines AS (SELECT page_id, doc_key, sentence, string_agg(word, ' ' ORDER BY token) AS a, string_agg(tag, ' ' ORDER BY token) AS b, string_agg(page_title, ' ' ORDER BY token) AS c FROM sent WHERE page_id = (SELECT page_id FROM first) GROUP BY ALL),
made AS (SELECT page_id, doc_key, {JOINED.replace('l,', 'a,')} AS text, {JOINED.replace('l,', 'b,')} AS tags, {JOINED.replace('l,', 'c,')} AS link_titles FROM lines GROUP BY ALL)
SELECT f.page_id, f.title AS page_title, coalesce(m.text, '') AS text, coalesce(m.tags, '') AS tags, coalesce(m.link_titles, '') AS link_titles FROM first f LEFT JOIN made m USING (page_id, doc_key)""",
    "linking_run": f"""WITH {PAYLOAD}, typed AS (SELECT * FROM parsed WHERE right(entity_id, 3) IN ('PER', 'LOC')), kept AS (SELECT * FROM typed WHERE page_id IN (SELECT page_id FROM typed GROUP BY 1 HAVING count(*) >= 3))
SELECT entity_id, '-' AS page_title, '-' AS wikidata, CAST(0 AS DOUBLE) AS proba, page_id AS on_page_id, page_title AS on_page, gt FROM kept WHERE length(entity_id) % 4 = 1
UNION ALL SELECT entity_id, 'c' || i || ':' || entity_id, 'Q' || length(entity_id), CAST(1 AS DOUBLE) / (i + 1), page_id, page_title, gt FROM kept, (VALUES (1), (2)) v(i) WHERE length(entity_id) % 4 > 1 AND i <= length(entity_id) % 4 - 1""",
    "ner_payload": f"WITH {PAYLOAD} SELECT * FROM payload",
    "linking_filter": f"WITH {PAYLOAD}, typed AS (SELECT * FROM parsed WHERE right(entity_id, 3) IN ('PER', 'LOC')) SELECT * FROM typed WHERE page_id IN (SELECT page_id FROM typed GROUP BY 1 HAVING count(*) >= 3)",
    "linking_flatten": f"""WITH {PAYLOAD} SELECT entity_id, '-' AS page_title, '-' AS wikidata, CAST(0 AS DOUBLE) AS proba, page_id AS on_page_id, page_title AS on_page, gt FROM parsed WHERE length(entity_id) % 4 = 1
UNION ALL SELECT entity_id, 'c' || i || ':' || entity_id, 'Q' || length(entity_id), CAST(1 AS DOUBLE) / (i + 1), page_id, page_title, gt FROM parsed, (VALUES (1), (2)) v(i) WHERE length(entity_id) % 4 > 1 AND i <= length(entity_id) % 4 - 1""",
}
