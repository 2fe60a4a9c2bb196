"""Reproducible train, dev and test sets of articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tesserae.operators.categories import pages
from tesserae.operators.ranks import global_rank


def articles(page: DataFrame, list_prefix: str = "Liste_", ambiguous_suffix: str = "Begriffsklärung)") -> DataFrame:
    return pages(page, 0).where(~F.col("page_title").startswith(list_prefix) & ~F.col("page_title").endswith(ambiguous_suffix))


def split(page: DataFrame, train: float, dev: float, test: float, seed: int = 41) -> DataFrame:
    """page_id, page_title, part: disjoint sets of exactly int(fraction * n) articles; the rest is in none."""
    if min(train, dev, test) <= 0 or train + dev + test > 1:
        raise ValueError("fractions must be positive and sum to at most 1")
    pool = articles(page)
    n = pool.count()
    sizes = [int(f * float(n)) for f in (train, dev, test)]
    a, b, c = sizes[0], sizes[0] + sizes[1], sum(sizes)
    ranked = global_rank(pool, F.md5(F.concat(F.lit(f"{seed}:"), F.col("page_id").cast("string"))), ["page_id"])
    part = F.when(F.col("rank") < a, "train").when(F.col("rank") < b, "dev").when(F.col("rank") < c, "test")
    return ranked.select("page_id", "page_title", part.alias("part")).where("part is not null")
