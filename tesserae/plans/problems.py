"""Queries and SQL of the general problems: hierarchies (P4) and orphan references (P6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.functions.titles import title_key_sql
from tesserae.operators import hierarchy as h, orphans as o
from tesserae.tables import table


def _tree(spark: SparkSession, d: str, paths: bool = True) -> DataFrame:
    return h.hierarchy(h.category_nodes(table(spark, d, "page"), table(spark, d, "categorylinks")), paths=paths)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d, paths=False).select(F.col("node").alias("page_id"), "root_id", "node_state")


def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select(F.col("node").alias("page_id"), F.col("parent").alias("parent_id"), "root_id", "depth", F.concat_ws("/", F.col("path").cast("array<string>")).alias("path"), "n_descendants", "node_state")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    return h.descendants(_tree(spark, d))


def _orphans(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return o.page_references(table(spark, d, "redirect"), table(spark, d, "tagged")), o.page_parents(table(spark, d, "page"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return o.find_orphans(*_orphans(spark, d))


def p6_counts(spark: SparkSession, d: str) -> DataFrame:
    return o.orphan_counts(*_orphans(spark, d))


_NODES = f"""
cats AS (SELECT page_id, {title_key_sql('page_title')} AS k FROM page WHERE page_namespace = 14 AND page_id IS NOT NULL),
by_title AS (SELECT k, min(page_id) AS parent FROM cats WHERE k IS NOT NULL GROUP BY k),
links AS (SELECT DISTINCT cl_from AS node, {title_key_sql('cl_to', True)} AS k FROM categorylinks),
linked AS (SELECT node, min(parent) AS parent FROM links JOIN by_title USING (k) GROUP BY node),
nodes AS (SELECT c.page_id AS node, l.parent FROM (SELECT DISTINCT page_id FROM cats) c LEFT JOIN linked l ON l.node = c.page_id),
up AS (SELECT node, node AS anc, 0 AS dist FROM nodes
  UNION ALL SELECT u.node, n.parent, u.dist + 1 FROM up u JOIN nodes n ON n.node = u.anc WHERE n.parent IS NOT NULL AND n.parent <> u.node AND u.dist < 200),
reach AS (SELECT node, anc, min(dist) AS dist FROM up GROUP BY ALL),
self AS (SELECT n.node FROM nodes n WHERE n.parent = n.node
  UNION SELECT r.node FROM reach r JOIN nodes n ON n.node = r.anc WHERE n.parent = r.node),
ring AS (SELECT r.node, min(r.anc) AS least FROM reach r JOIN self USING (node) GROUP BY r.node),
top AS (SELECT r.node, r.anc AS root, r.dist FROM reach r JOIN nodes n ON n.node = r.anc WHERE n.parent IS NULL),
enter AS (SELECT r.node, arg_min(g.node, r.dist) AS at, min(r.dist) AS dist, min(g.least) AS least FROM reach r JOIN ring g ON g.node = r.anc GROUP BY r.node),
state AS (SELECT n.node, n.parent, CASE WHEN g.node IS NOT NULL THEN g.least WHEN e.node IS NOT NULL THEN e.least ELSE t.root END AS root_id,
  CASE WHEN g.node IS NOT NULL THEN 'cycle' WHEN e.node IS NOT NULL THEN 'below_cycle' ELSE 'tree' END AS node_state,
  CASE WHEN g.node IS NOT NULL THEN 0 WHEN e.node IS NOT NULL THEN e.dist ELSE t.dist END AS depth
  FROM nodes n LEFT JOIN ring g USING (node) LEFT JOIN enter e USING (node) LEFT JOIN top t USING (node))
"""

_LONG = f"""
parents AS (SELECT 'id' AS space, CAST(page_id AS VARCHAR) AS k, deleted_at IS NULL AS live, loaded_at FROM page
  UNION ALL SELECT 'ns' || page_namespace, {title_key_sql('page_title')}, deleted_at IS NULL, loaded_at FROM page),
owner AS (SELECT space, k, bool_or(live) AS live, coalesce(min(loaded_at) FILTER (WHERE live), min(loaded_at)) AS first_ts FROM parents WHERE k IS NOT NULL GROUP BY ALL),
link AS (SELECT page_id, loaded_at, unnest(flatten(CAST(CAST(link_titles AS JSON) AS VARCHAR[][]))) AS v FROM tagged),
refs AS (SELECT 'redirect' AS ref_table, 'rd_from' AS ref_field, rd_from AS ref_id, CAST(rd_from AS VARCHAR) AS ref_value, 'id' AS space, CAST(rd_from AS VARCHAR) AS k, loaded_at AS ts FROM redirect
  UNION ALL SELECT 'redirect', 'rd_title', rd_from, rd_title, 'ns' || rd_namespace, {title_key_sql('rd_title')}, loaded_at FROM redirect
  UNION ALL SELECT 'tagged', 'link_titles', page_id, v, 'ns0', {title_key_sql("regexp_replace(v, '#.*$', '', 's')")}, loaded_at FROM link WHERE v <> ''),
judged AS (SELECT DISTINCT ref_table, ref_field, ref_id, ref_value,
  CASE WHEN o.k IS NULL THEN 'missing' WHEN NOT o.live THEN 'deleted' WHEN o.first_ts > r.ts THEN 'late' END AS miss_kind, strftime(r.ts, '%Y-%m') AS ref_month
  FROM refs r LEFT JOIN owner o ON o.space = r.space AND o.k = r.k WHERE r.k IS NOT NULL)
"""

QUERIES = {"p4_found": p4_found, "p4_hierarchy": p4_hierarchy, "p4_descendants": p4_descendants, "p6_found": p6_found, "p6_counts": p6_counts}

SQL = {
    "p4_found": f"WITH RECURSIVE {_NODES} SELECT node AS page_id, root_id, node_state FROM state",
    "p4_hierarchy": f"""WITH RECURSIVE {_NODES},
steps AS (SELECT s.node, string_agg(CAST(r.anc AS VARCHAR), '/' ORDER BY r.dist DESC) AS path FROM state s JOIN reach r ON r.node = s.node AND r.dist <= s.depth GROUP BY s.node),
size AS (SELECT root_id, count(*) AS n FROM state GROUP BY 1),
below AS (SELECT r.anc AS node, count(*) AS n FROM state s JOIN reach r ON r.node = s.node AND r.dist <= s.depth AND r.dist > 0 GROUP BY 1)
SELECT s.node AS page_id, s.parent AS parent_id, s.root_id, CAST(s.depth AS INTEGER) AS depth, p.path,
  CASE WHEN s.node_state = 'cycle' THEN z.n - 1 ELSE coalesce(b.n, 0) END AS n_descendants, s.node_state
FROM state s JOIN steps p USING (node) JOIN size z USING (root_id) LEFT JOIN below b ON b.node = s.node""",
    "p4_descendants": f"WITH RECURSIVE {_NODES} SELECT r.anc AS ancestor_id, s.node AS descendant_id, CAST(r.dist AS INTEGER) AS distance FROM state s JOIN reach r ON r.node = s.node AND r.anc <> s.node",
    "p6_found": f"WITH {_LONG} SELECT * FROM judged WHERE miss_kind IS NOT NULL",
    "p6_counts": f"WITH {_LONG} SELECT ref_table, ref_field, miss_kind, ref_month, count(*) AS n_refs, count(DISTINCT ref_value) AS n_targets FROM judged WHERE miss_kind IS NOT NULL GROUP BY ALL",
}
