"""Global ranks and first rows per key without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def global_rank(df: DataFrame, hashed: Column, ties: list[str], name: str = "rank") -> DataFrame:
    """0-based rank in the order of `hashed` (a hexadecimal digest), then of ties.

    The first three digits cut the rows into 4,096 even ranges; a range's rows
    before it are summed over the ranges, and only ranges are sorted.
    """
    keyed = df.withColumn("_h", hashed).withColumn("_range", F.substring("_h", 1, 3))
    sums = keyed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")  # at most 4,096 rows
    own = F.row_number().over(Window.partitionBy("_range").orderBy("_h", *ties)) - 1
    return keyed.withColumn("_own", own).join(F.broadcast(before), "_range").withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_h", "_range", "_own", "_before")


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key, as one hash aggregate: hot keys shrink before they are shuffled.

    order: names, ascending; nulls last.
    """
    rank = [x for c in order for x in (F.col(c).isNull().alias(f"_{c}_null"), F.col(c).alias(f"_{c}"))]
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*rank)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
