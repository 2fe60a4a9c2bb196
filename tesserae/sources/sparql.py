"""Results of a SPARQL endpoint as a DataFrame of strings."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Fixed value: the public endpoint.
ENDPOINT = "https://query.wikidata.org/bigdata/namespace/wdq/sparql"
# A small query to try it: rivers and where they end.
DEMO = "SELECT ?river ?mouth WHERE { ?river wdt:P31 wd:Q4022 ; wdt:P403 ?mouth . } LIMIT 20"


def query_text(query: str | None, query_file: str | None, demo: bool = False, lang: str | None = None, site: str | None = None) -> str:
    """Exactly one of query and query_file, or the demo; __LANG__ and __SITE__ are filled in."""
    if query is not None and query_file is not None:
        raise ValueError("give a query or a file, not both")
    if query_file is not None:
        with open(query_file, encoding="utf-8") as f:
            query = f.read()
    if query is None:
        if not demo:
            raise ValueError("a query or a file is needed")
        query = DEMO
    for mark, value in (("__LANG__", lang), ("__SITE__", site)):
        if value is not None:
            query = query.replace(mark, value)
    return query


def fetch(url: str) -> str:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"Accept": "application/json"})) as r:
        return r.read().decode()


def run_sparql(spark: SparkSession, query: str, endpoint: str = ENDPOINT, analytic: bool = False, get: Callable[[str], str] = fetch) -> DataFrame:
    """One row a solution; all values are strings, unbound variables null. No solutions are an error."""
    url = endpoint + ("&" if "?" in endpoint else "?") + urllib.parse.urlencode({"query": query, "analytic": str(analytic).lower()})
    found = json.loads(get(url))["results"]["bindings"]
    if not found:
        raise ValueError("the query has no solutions")
    names = list(dict.fromkeys(k for b in found for k in b))
    return spark.createDataFrame([tuple(b[n]["value"] if n in b else None for n in names) for b in found], ", ".join(f"`{n}` string" for n in names))
