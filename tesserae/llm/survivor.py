"""P5: the best representative of each duplicate group, by skyline selection."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

FIELDS = ("dateofbirth", "inception", "coords")

# The look of a usable point, and of an item's number.
POINT = r"^Point\(\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s+([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)\s*\)$"
FULL_WIDTH = ("０１２３４５６７８９Ｑｑ", "0123456789Qq")

BEST = "qid string, ent_id long, modified_at timestamp_ntz, trust_rank int, dateofbirth timestamp_ntz, inception timestamp_ntz, coords string, from_dateofbirth long, from_inception long, from_coords long, n_rows long, n_skyline int, clear boolean"


def item_key(wikidata: Column) -> Column:
    """`Q` and the item's number in plain digits, however the item is written; null if there is none."""
    plain = F.translate(wikidata, *FULL_WIDTH)
    number = F.regexp_extract(plain, r"(?:^|[^A-Za-z0-9])[Qq]0*([0-9]+)(?![0-9A-Za-z])", 1)
    return F.when(number != "", F.concat(F.lit("Q"), number))


def usable_point(coords: Column) -> Column:
    """coords if it reads Point(lon lat) within 180 and 90 degrees, else null."""
    c = F.trim(coords)
    lon, lat = (F.regexp_extract(c, POINT, i).try_cast("double") for i in (1, 2))
    return F.when((F.abs(lon) <= 180) & (F.abs(lat) <= 90), coords)


def _reduced(entities: DataFrame, class_trust: DataFrame) -> DataFrame:
    """At most one row for each item, set of held fields and trust: the latest.

    An older row with the same fields held and the same trust is dominated by
    it and can neither survive nor fill a null, so nothing is lost, and an
    item's rows shrink to at most 8 times the number of trust ranks before
    they meet in one place, however many there are.
    """
    trust = class_trust.groupBy("src_class").agg(F.min("trust_rank").alias("trust_rank"))
    rows = entities.select(item_key(F.col("wikidata")).alias("qid"), "ent_id", F.col("dateofbirth").cast("timestamp_ntz").alias("dateofbirth"), F.col("inception").cast("timestamp_ntz").alias("inception"), usable_point(F.col("coords")).alias("coords"), F.col("modified_at").cast("timestamp_ntz").alias("modified_at"), "src_class").where("qid is not null")
    rows = rows.join(trust, "src_class", "left").drop("src_class")
    held = sum((F.when(F.col(f).isNotNull(), 1 << i).otherwise(0) for i, f in enumerate(FIELDS)), F.lit(0)).cast("int")
    # among rows of the same time the smallest ent_id wins; a null time is older than any
    latest = F.max(F.struct(F.col("modified_at").isNotNull().alias("dated"), F.col("modified_at"), (-F.col("ent_id")).alias("neg"), *FIELDS, "ent_id")).alias("best")
    return rows.withColumn("held", held).groupBy("qid", "held", "trust_rank").agg(latest, F.count(F.lit(1)).alias("n"))


def _layers(rows: list[dict]) -> list[list[dict]]:
    """Successive layers of rows that none of the rest dominates."""

    def beats(a: dict, b: dict) -> bool:
        no_worse = a["held"] | b["held"] == a["held"] and a["time"] >= b["time"] and a["trust"] <= b["trust"]
        return no_worse and (a["held"] != b["held"] or a["time"] > b["time"] or a["trust"] < b["trust"])

    rest, out = rows, []
    while rest:
        top = [r for r in rest if not any(beats(o, r) for o in rest if o is not r)]
        out.append(top)
        rest = [r for r in rest if all(r is not t for t in top)]
    return out


def _choose(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    worst = 1 << 30
    for part in parts:
        out = []
        for qid, cands in zip(part["qid"], part["cands"]):
            rows = []
            for c in cands:
                c = c.asDict() if hasattr(c, "asDict") else c
                trust = c["trust_rank"]
                rows.append({**c, "trust": worst if trust is None or trust != trust else int(trust), "time": (0, 0) if c["modified_at"] is None else (1, pd.Timestamp(c["modified_at"]).value)})
            layers = _layers(rows)
            policy = lambda r: (-bin(r["held"]).count("1"), tuple(-x for x in r["time"]), r["trust"], r["ent_id"])
            order = [r for layer in layers for r in sorted(layer, key=policy)]
            best = order[0]
            union = 0
            for r in rows:
                union |= r["held"]
            rest = [r for r in rows if r is not best]
            total = sum(r["n"] for r in rows)
            clear = total >= 2 and union > 0 and best["held"] == union and all(r["time"] < best["time"] for r in rest) and best["n"] == 1 and all(r["trust"] > best["trust"] for r in rest)
            rec = {"qid": qid, "ent_id": best["ent_id"], "modified_at": best["modified_at"], "trust_rank": None if best["trust"] == worst else best["trust"], "n_rows": total, "n_skyline": len(layers[0]), "clear": bool(clear)}
            for i, f in enumerate(FIELDS):
                giver = next((r for r in order if r["held"] >> i & 1), None)
                rec[f], rec[f"from_{f}"] = (giver[f], giver["ent_id"]) if giver else (None, None)
            out.append(rec)
        names = [x.split()[0] for x in BEST.split(", ")]
        df = pd.DataFrame(out, columns=names)
        for f in ("trust_rank", *(f"from_{x}" for x in FIELDS)):
            df[f] = df[f].astype("Int64")
        for f in ("modified_at", "dateofbirth", "inception"):
            df[f] = pd.to_datetime(df[f])
        yield df


def best_records(entities: DataFrame, class_trust: DataFrame) -> DataFrame:
    """One record per item: the surviving row, with nulls filled field by field.

    The survivor is chosen from the skyline, the rows that no row of the item
    dominates in completeness (fields held), recency (modified_at) and trust
    (trust_rank), by the policy most fields, then latest, then most trusted,
    then smallest ent_id. A field it lacks comes from the next row in the
    order of the dominance layers, which from_<field> names. clear: the row
    is strictly best in every respect. Null times are the oldest, unknown
    classes the least trusted; rows without an item number are no records;
    repeated rows (the same time and trust) tie, so none of them is clear.
    """
    cands = _reduced(entities, class_trust).withColumn("c", F.struct(F.col("best.ent_id").alias("ent_id"), F.col("best.modified_at").alias("modified_at"), "trust_rank", "held", *[F.col(f"best.{f}").alias(f) for f in FIELDS], "n"))
    grouped = cands.groupBy("qid").agg(F.collect_list("c").alias("cands"))
    return grouped.mapInPandas(_choose, BEST)


def clear_winners(entities: DataFrame, class_trust: DataFrame) -> DataFrame:
    """qid, ent_id for items with at least two rows one of which is best in every respect."""
    return best_records(entities, class_trust).where("clear").select("qid", "ent_id")
