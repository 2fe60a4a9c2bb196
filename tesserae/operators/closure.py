"""Transitive closure by frontier joins, safe on cycles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tesserae.session import drop_materialized, materialize, written_sums


def closure(edges: DataFrame, roots: DataFrame, levels: int = 6) -> DataFrame:
    """root, node, depth: every node that a root reaches, the root included.

    edges(parent, child), roots(root). All roots at once, `levels` levels a
    round: a round is one job, which joins the frontier to the edges level by
    level and writes what no round has met before. Edges stand with their
    parent, in lists of at most some thousands of children, so a parent's
    children are repeated for as many roots as reach it and hot parents are cut.
    depth is the fewest edges. Null ends and repeated edges don't count; a root
    without edges reaches itself only.
    """
    pairs = edges.where("parent is not null and child is not null").select("parent", "child").distinct()
    share = F.pmod(F.xxhash64("child"), F.lit(64))
    links = materialize(pairs.groupBy("parent", share.alias("share")).agg(F.collect_list("child").alias("children")).drop("share"), "edges")
    own = roots.where("root is not null").select("root", F.col("root").alias("node")).distinct().withColumn("depth", F.lit(0))
    frontier = materialize(own, "reached", n=F.lit(1))
    seen, depth = [frontier], 0
    while True:
        step, steps = frontier.select("root", "node"), []
        for level in range(1, levels + 1):
            step = step.withColumnRenamed("node", "parent").join(links, "parent").select("root", F.explode("children").alias("node")).distinct()
            steps.append(step.withColumn("depth", F.lit(depth + level)))
        met = reduce(DataFrame.unionByName, steps).groupBy("root", "node").agg(F.min("depth").alias("depth"))
        known = reduce(DataFrame.unionByName, seen).select("root", "node")
        depth += levels
        fresh = materialize(met.join(known, ["root", "node"], "left_anti"), "reached", n=F.lit(1), last=F.col("depth") == depth)
        seen.append(fresh)
        if not written_sums(fresh)["last"]:
            drop_materialized(links)
            return reduce(DataFrame.unionByName, seen)
        frontier = fresh.where(F.col("depth") == depth)
