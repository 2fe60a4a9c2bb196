"""Batch entity linking: request payloads, filters, flattened rankings."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tesserae.session import materialize

log = logging.getLogger(__name__)

LISTS = "array<array<string>>"
RANKED = "page_id long, page_title string, entity_id string, gt string, ranking array<struct<label:string,wikidata:string,proba:double>>"


def payload(tagged: DataFrame) -> DataFrame:
    """page_id, page_title, sentences: arrays of (word, prediction, gt).

    Lists of unequal length are cut to the shortest, sentences and tokens alike.
    """
    t = tagged.select("page_id", "page_title", *[F.from_json(c, LISTS).alias(c) for c in ("text", "tags", "link_titles")])
    # element by element of arrays cut to the same length
    cut = lambda arrays: [F.slice(a, 1, F.least(*[F.size(x) for x in arrays])) for a in arrays]
    w, p, g = cut([F.col("text"), F.col("tags"), F.col("link_titles")])
    rows = t.withColumn("zipped", F.arrays_zip(w.alias("w"), p.alias("p"), g.alias("g")))

    def sentence(x):  # noqa: ANN001, ANN202
        a, b, c = cut([x["w"], x["p"], x["g"]])
        return F.transform(F.arrays_zip(a.alias("word"), b.alias("prediction"), c.alias("gt")), lambda y: F.struct(y["word"].alias("word"), y["prediction"].alias("prediction"), y["gt"].alias("gt")))

    return rows.select("page_id", "page_title", F.transform("zipped", sentence).alias("sentences"))


def filter_entities(parsed: DataFrame, types: set[str] | None = None, least: int | None = None) -> DataFrame:
    """parsed(page_id, page_title, entity_id, gt) of the given types (last three characters), then of
    pages with at least `least` entities left. Counts are joined, not collected, so a page may be of any size.
    """
    out = parsed
    if types is not None:
        out = out.where(F.substring("entity_id", -3, 3).isin(sorted(types)))
    if least is not None:
        counts = out.groupBy("page_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
        out = out.join(counts.select("page_id"), "page_id", "left_semi")
    return out


def flatten_rankings(ranked: DataFrame) -> DataFrame:
    """entity_id, page_title, wikidata, proba, on_page_id, on_page, gt.

    A missing ranking gives one row `-` with proba 0, an empty one no row.
    """
    none = F.array(F.struct(F.lit("-").alias("label"), F.lit("-").alias("wikidata"), F.lit(0.0).alias("proba")))
    rows = ranked.select("entity_id", "gt", F.col("page_id").alias("on_page_id"), F.col("page_title").alias("on_page"), F.explode(F.coalesce("ranking", none)).alias("r"))
    return rows.select("entity_id", F.col("r.label").alias("page_title"), F.col("r.wikidata").alias("wikidata"), F.col("r.proba").alias("proba"), "on_page_id", "on_page", "gt")


class HttpClient:
    """The two calls of a linking service; needs the package requests, which is imported when called."""

    def __init__(self, endpoint: str, threshold: float = 0.01, timeout: float = 1800, noproxy: bool = False) -> None:
        self.endpoint, self.threshold, self.timeout, self.noproxy = endpoint, threshold, timeout, noproxy

    def _post(self, path: str, body: object) -> object:
        import requests

        with requests.Session() as session:
            session.trust_env = not self.noproxy  # else proxies come from the environment
            resp = session.post(self.endpoint + path, json=body, timeout=self.timeout)
        resp.raise_for_status()
        return resp.json()

    def parse(self, sentences: list) -> dict:
        return self._post("/parse", sentences)  # an error here ends the run

    def ned(self, parsed: dict) -> dict | None:
        import requests

        try:
            return self._post(f"/ned?threshold={self.threshold}", parsed)
        except requests.HTTPError as e:
            log.warning("page skipped: %s", e)
            return None


def run(tagged: DataFrame, client: Callable[[], object], types: set[str] | None = None, least: int | None = None, seed: int | None = None) -> DataFrame:
    """The whole batch with an injected client: an object with parse(sentences) and ned(parsed), made once a task.

    What is parsed is written, so that no page is sent twice; filter_entities
    chooses among it, and a page's entities go to the second call together.
    With a seed the pages are sent in an order of chance, which spreads
    expensive ones; the same seed gives the same order.
    """
    rows = payload(tagged).select("page_id", "page_title", F.to_json("sentences").alias("body"))
    if seed is not None:
        rows = rows.orderBy(F.xxhash64("page_id", "body", F.lit(seed)))

    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = client()
        for part in parts:
            found = [(page, title, k, i, json.dumps(v)) for page, title, body in zip(part["page_id"], part["page_title"], part["body"]) for i, (k, v) in enumerate(service.parse(json.loads(body)).items())]
            yield pd.DataFrame(found, columns=["page_id", "page_title", "entity_id", "place", "value"])

    def rank(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = client()
        for part in parts:
            out = []
            for page, title, own in zip(part["page_id"], part["page_title"], part["own"]):
                parsed = {e["entity_id"]: json.loads(e["value"]) for e in own}
                for k, v in (service.ned(parsed) or {}).items():
                    if k in parsed:
                        ranking = [{"label": name, "wikidata": r["wikidata"], "proba": float(r["proba_1"])} for name, r in v["ranking"]] if "ranking" in v else None
                        out.append((page, title, k, parsed[k]["gt"][0], ranking))
            yield pd.DataFrame(out, columns=["page_id", "page_title", "entity_id", "gt", "ranking"])

    parsed = materialize(rows.mapInPandas(parse, "page_id long, page_title string, entity_id string, place int, value string"), "parsed")
    chosen = filter_entities(parsed, types, least).groupBy("page_id", "page_title").agg(F.sort_array(F.collect_list(F.struct("place", "entity_id", "value"))).alias("own"))
    return flatten_rankings(chosen.mapInPandas(rank, RANKED))
