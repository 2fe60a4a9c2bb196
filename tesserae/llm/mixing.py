"""P8: mixing sources to target weights.

A text may stand in several sources. Texts are aggregated by membership
pattern, the set of a mix's sources that hold them, so the planning sees at
most one number for each set of sources. A min-cost flow routes the patterns'
tokens to the sources' quotas; the k-th use of a text costs more than the one
before, so nothing is repeated while anything fresh is left. The largest total
is taken at which every quota can still be met. Texts are then selected in a
seeded order, by their place in the running sum of their pattern's tokens.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tesserae.session import materialize

SELECTED = "mix_name string, source string, doc_id long, tokens long, n_uses int"


class Flow:
    """Min-cost flow by successive shortest paths, for networks of a few hundred edges."""

    def __init__(self) -> None:
        self.to: list[int] = []
        self.cap: list[int] = []
        self.cost: list[int] = []
        self.out: dict[int, list[int]] = {}

    def edge(self, a: int, b: int, cap: int, cost: int = 0) -> int:
        for u, v, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out.setdefault(u, []).append(len(self.to))
            self.to.append(v)
            self.cap.append(c)
            self.cost.append(w)
        return len(self.to) - 2

    def run(self, s: int, t: int) -> int:
        total = 0
        while True:
            dist, via, queue, inside = {s: 0}, {}, deque([s]), {s}
            while queue:
                u = queue.popleft()
                inside.discard(u)
                for e in self.out.get(u, ()):
                    v = self.to[e]
                    if self.cap[e] > 0 and dist[u] + self.cost[e] < dist.get(v, 1 << 60):
                        dist[v], via[v] = dist[u] + self.cost[e], e
                        if v not in inside:
                            inside.add(v)
                            queue.append(v)
            if t not in dist:
                return total
            push, v = 1 << 62, t
            while v != s:
                push = min(push, self.cap[via[v]])
                v = self.to[via[v] ^ 1]
            v = t
            while v != s:
                self.cap[via[v]] -= push
                self.cap[via[v] ^ 1] += push
                v = self.to[via[v] ^ 1]
            total += push


def route(mass: dict[frozenset, int], share: dict[str, float], repeats: dict[str, int]) -> tuple[int, dict[tuple[frozenset, str], int]]:
    """The largest total, and the tokens that each pattern gives to each source.

    A text is used no more often, over all sources, than the least of the
    max_repeats of its sources in the mix. Sources that hold nothing are left
    out and the other shares scaled to sum to one.
    """
    names = [s for s in share if share[s] > 0 and repeats[s] > 0 and any(s in p and m > 0 for p, m in mass.items())]
    if not names:
        return 0, {}
    whole = sum(share[s] for s in names)
    parts = {s: share[s] / whole for s in names}
    usable = {p & frozenset(names): 0 for p in mass if p & frozenset(names)}
    for p, m in mass.items():
        if p & frozenset(names):
            usable[p & frozenset(names)] += m
    pats = sorted(usable, key=sorted)

    def flow(total: int) -> tuple[bool, Flow, dict[tuple[frozenset, str], int]]:
        f, arcs = Flow(), {}
        at = {p: 2 + i for i, p in enumerate(pats)}
        goal = {s: 2 + len(pats) + i for i, s in enumerate(names)}
        quota = {s: int(total * parts[s]) for s in names}
        for p in pats:
            for k in range(min(repeats[s] for s in p)):
                f.edge(0, at[p], usable[p], k * k + k)  # convex: each further use costs more
            for s in sorted(p):
                arcs[(p, s)] = f.edge(at[p], goal[s], 1 << 60)
        for s in names:
            f.edge(goal[s], 1, quota[s])
        return f.run(0, 1) == sum(quota.values()), f, arcs

    low, high = 0, int(min(sum(usable[p] * repeats[s] for p in pats if s in p) / parts[s] for s in names)) + 1
    while high - low > 1:
        mid = (low + high) // 2
        if flow(mid)[0]:
            low = mid
        else:
            high = mid
    _, f, arcs = flow(low)
    return low, {k: f.cap[e ^ 1] for k, e in arcs.items() if f.cap[e ^ 1] > 0}


def unique_texts(sized: DataFrame) -> DataFrame:
    """text_key, tokens, members: each source that holds the text, with its smallest doc_id.

    sized: doc_id, source, text_key, tokens. Null sources and texts without tokens are no members.
    """
    own = sized.where("tokens > 0 and source is not null and text_key is not null").groupBy("text_key", "source").agg(F.min("doc_id").alias("doc_id"), F.max("tokens").alias("tokens"))
    return own.groupBy("text_key").agg(F.max("tokens").alias("tokens"), F.sort_array(F.collect_list(F.struct("source", "doc_id"))).alias("members"))


def select(sized: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """mix_name, source, doc_id, tokens, n_uses of every text that a mix takes, per source it stands for.

    targets: mix_name, source, target_share, max_repeats, one row each (of
    repeated rows the largest values count; nulls count as zero). Every source
    ends within one text a pattern of its share of the total; equal seeds give
    equal selections.
    """
    goals = targets.where("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")).collect()  # the table of mixes is given by hand
    mixes: dict[str, dict[str, tuple[float, int]]] = {}
    for r in goals:
        mixes.setdefault(r["mix_name"], {})[r["source"]] = (r["share"] or 0.0, r["repeats"] or 0)
    wanted = sorted({s for m in mixes.values() for s in m})
    texts = unique_texts(sized.where(F.col("source").isin(wanted)) if wanted else sized.limit(0))
    order = F.pmod(F.xxhash64("text_key", F.lit(seed)), F.lit(1 << 40))
    texts = materialize(texts.withColumn("pattern", F.concat_ws("\x1f", F.col("members.source"))).withColumn("place", order), "texts")
    sums = texts.groupBy("pattern").agg(F.sum("tokens").alias("mass"), F.count(F.lit(1)).alias("n")).collect()  # at most one row a set of wanted sources
    mass = {frozenset(r["pattern"].split("\x1f")): int(r["mass"]) for r in sums}
    total = sum(r["n"] for r in sums)
    uses: dict[tuple[str, str], list[tuple[str, float]]] = {}
    for mix, own in mixes.items():
        present = frozenset(s for s, (share, most) in own.items() if share > 0 and most > 0)
        reduced: dict[frozenset, int] = {}
        for p, m in mass.items():
            reduced[p & present] = reduced.get(p & present, 0) + m
        _, given = route(reduced, {s: x[0] for s, x in own.items()}, {s: x[1] for s, x in own.items()})
        for p in mass:
            uses[(mix, "\x1f".join(sorted(p)))] = [(s, t / reduced[q]) for (q, s), t in sorted(given.items(), key=lambda x: x[0][1]) if q == p & present]
    buckets = max(1, total // 50_000)
    step = (1 << 40) // buckets + 1
    keyed = texts.withColumn("bucket", F.floor(F.col("place") / step).cast("int"))
    part = keyed.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("part"))
    before = part.withColumn("before", F.coalesce(F.sum("part").over(Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("part")
    own = F.coalesce(F.sum("tokens").over(Window.partitionBy("pattern", "bucket").orderBy("place", "text_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    masses = {r["pattern"]: int(r["mass"]) for r in sums}
    placed = keyed.withColumn("own", own).join(before, ["pattern", "bucket"]).select("pattern", "members", "tokens", (F.col("own") + F.col("before") + F.col("tokens") / 2).alias("at"))
    shared = sized.sparkSession.sparkContext.broadcast((uses, masses, sorted(mixes)))

    def draw(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uses, masses, names = shared.value
        for part in parts:
            out = []
            for pattern, members, tokens, at in zip(part["pattern"], part["members"], part["tokens"], part["at"]):
                ids = {m["source"]: m["doc_id"] for m in members}
                u = at / masses[pattern]
                for mix in names:
                    top = 0.0
                    for source, x in uses.get((mix, pattern), ()):
                        # uses stand at u, u + 1, u + 2, ...; the source gets those within its stretch
                        lo, top = top, top + x
                        n = max(0, -int(-(top - u) // 1)) - max(0, -int(-(lo - u) // 1))
                        if n > 0:
                            out.append((mix, source, ids[source], tokens, n))
            yield pd.DataFrame(out, columns=["mix_name", "source", "doc_id", "tokens", "n_uses"])

    return placed.mapInPandas(draw, SELECTED)


def shares(selected: DataFrame, targets: DataFrame) -> DataFrame:
    """What each source of each mix got; sources that gave nothing have a share of 0.

    scaled_share is the target among the sources that gave anything: what can
    be reached where a wanted source holds nothing.
    """
    got = selected.groupBy("mix_name", "source").agg(F.sum(F.col("tokens") * F.col("n_uses")).alias("tokens"), F.count(F.lit(1)).alias("n_texts"), F.max("n_uses").alias("most_uses"))
    goal = targets.where("mix_name is not null and source is not null").groupBy("mix_name", "source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = goal.join(got, ["mix_name", "source"], "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    gave = F.when(F.col("tokens") > 0, F.col("target_share")).otherwise(0.0)
    whole = rows.groupBy("mix_name").agg(F.sum("tokens").alias("all_tokens"), F.sum(gave).alias("all_shares"))
    rows = rows.join(whole, "mix_name")  # both sides as long as the table of mixes
    return rows.select("mix_name", "source", "target_share", (gave / F.col("all_shares")).alias("scaled_share"), (F.col("tokens") / F.col("all_tokens")).alias("actual_share"), "tokens", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats")
