"""Joins to a side with unique keys that survive keys holding a third of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F


def skew_lookup(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", max_hot: int = 65_536, least: int = 50_000, rows: int | None = None) -> DataFrame:
    """left joined to right, whose keys are unique, with hot keys of left salted; how is left or inner.

    A key is hot if it holds more than `least` rows, or at 10^10 rows and more
    than a 1/max_hot share of them: so no task gets much more than that of a
    key, and at most max_hot keys are listed, which bounds what is broadcast.
    A hot key's rows get one of as many salts as make shares of about that
    size, and only its row of right is repeated per salt. Null keys never
    match: they take no part in the join, and a left join keeps their rows.
    rows is how many rows left has at most, if known: of `least` or fewer none
    can be hot, and they are not counted.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    whole, left = left, left.where(present)
    hot = _hot(left, keys, max_hot, least) if rows is None or rows > least else []
    if hot:
        names = left.sparkSession.createDataFrame(hot, left.select(*keys).schema.add("_salts", "long"))
        last = F.coalesce(F.col("_salts"), F.lit(1)) - 1
        spread = right.join(F.broadcast(names), keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_salts")
        salt = F.when(F.col("_salts").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64(*left.columns), F.col("_salts")))
        joined = left.join(F.broadcast(names), keys, "left").withColumn("_salt", salt).drop("_salts").join(spread, [*keys, "_salt"], how).drop("_salt")
    else:
        joined = left.join(right, keys, how)
    if how != "left":
        return joined
    rest = whole.where(~present)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in keys]
    return joined.unionByName(rest.select("*", *nothing))


def _hot(left: DataFrame, keys: list[str], max_hot: int, least: int) -> list[tuple]:
    """Each hot key and its number of salts."""
    seen = Observation()
    counted = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    top = counted.where(F.col("_n") > least).orderBy(F.desc("_n")).limit(max_hot).collect()  # one pass gives the total as well
    most = max(least, seen.get["total"] // max_hot) if top else least
    return [(*[r[k] for k in keys], -(-r["_n"] // most)) for r in top if r["_n"] > most]
