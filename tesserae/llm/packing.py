"""P7: filling fixed-capacity containers with items.

Pattern packing: what is packed is the histogram of item sizes, at most one
number for each size up to the capacity, so the planning costs the same for
any number of items. Patterns of one to three sizes that fill a container are
enumerated over a grid of sizes; their repeat counts are fitted to the
histogram by non-negative least squares and rounded down; the rest of the
histogram is packed, largest size first, each gap by the largest that fits.
The grid coarsens sizes to a 256th of the capacity when patterns are chosen;
what a pattern leaves open by that is filled from the rest, too. Each kind of
container is planned in a task of its own. Items then find their place by their
rank among the items of their size, which is counted without bringing a size's
items to one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from tesserae.session import materialize, written_sums

GRID = 256
PLACED = "spec_name string, container_id long, doc_id long, piece_no int, token_start long, token_end long"


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set over the normal equations of its columns."""
    n = a.shape[1]
    x = np.zeros(n)
    free = np.zeros(n, bool)
    limit = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        at = np.flatnonzero(free)
        slope = a.T @ (b - a[:, at] @ x[at])
        slope[free] = -np.inf
        j = int(np.argmax(slope))
        if slope[j] <= limit or len(at) >= a.shape[0]:
            break
        free[j] = True
        while True:
            at = np.flatnonzero(free)
            own = a[:, at]
            s = np.linalg.solve(own.T @ own + 1e-9 * np.eye(len(at)), own.T @ b)
            if (s > 0).all():
                x[:] = 0
                x[at] = s
                break
            low = s <= 0
            step = (x[at][low] / np.maximum(x[at][low] - s[low], 1e-300)).min(initial=1.0)
            x[at] += step * (s - x[at])
            x[x < 1e-12] = 0
            free &= x > 0
            if not free.any():
                break
    return x


def patterns(grid: int) -> list[tuple[int, ...]]:
    """One to three sizes, in steps of the grid, that fill a container."""
    out: list[tuple[int, ...]] = [(grid,)]
    out += [(a, grid - a) for a in range(grid - 1, (grid - 1) // 2, -1) if a >= grid - a]
    out += [(a, b, grid - a - b) for a in range(grid - 2, 0, -1) for b in range(min(a, grid - a - 1), 0, -1) if 0 < grid - a - b <= b]
    return out


class _Stock:
    """How many items of each size are left, and the largest size at hand up to a bound, found in next to constant time."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left: list[int] = counts.tolist()
        self.left[0] = 0
        self.down = [s if n or not s else s - 1 for s, n in enumerate(self.left)]  # sizes used up point below

    def largest(self, bound: int) -> int:
        """The largest size up to bound of which there are items, or 0."""
        top = bound
        while self.down[top] != top:
            top = self.down[top]
        while self.down[bound] != top and bound != top:
            self.down[bound], bound = top, self.down[bound]
        return top

    def take(self, used: dict[int, int], most: int) -> int:
        """Take `used` items of each size as often as there are, at most `most` times; how often."""
        k = min([most, *(self.left[s] // u for s, u in used.items())])
        for s, u in used.items():
            self.left[s] -= k * u
            if not self.left[s]:
                self.down[s] = s - 1
        return k

    def fill(self, used: dict[int, int], gap: int) -> list[int]:
        """The largest sizes at hand, besides those used, that fit a gap one after another; used counts them."""
        added = []
        while gap > 0:
            s = self.largest(gap)
            while s and self.left[s] <= used.get(s, 0):
                s = self.largest(s - 1)
            if not s:
                break
            used[s] = used.get(s, 0) + 1
            added.append(s)
            gap -= s
        return added


def plan(counts: np.ndarray, capacity: int, grid: int = GRID) -> list[tuple[tuple[int, ...], int]]:
    """(sizes, number of containers) that place counts[s] items of each size s, 1 to capacity.

    Each entry uses up a size but for a few items, so there are about as many
    as sizes, whatever the number of items.
    """
    stock = _Stock(counts.astype(np.int64))
    grid = min(grid, capacity)
    cls = -(-np.arange(capacity + 1) * grid // capacity)  # rounded up, so what fits the grid fits
    top = {int(c): int(s) for s, c in enumerate(cls)}  # the largest size of each class
    have = np.bincount(cls, weights=np.array(stock.left), minlength=grid + 1)
    usable = [p for p in patterns(grid) if all(have[c] > 0 for c in p)]
    out: list[tuple[tuple[int, ...], int]] = []
    whole: list[tuple[list[int], int]] = []
    if usable:
        a = np.zeros((grid, len(usable)))
        for j, p in enumerate(usable):
            for c in p:
                a[c - 1, j] += 1
        repeat = nnls(a, have[1:])
        for j in np.argsort(-repeat, kind="stable"):
            n = int(repeat[j] + 1e-6)
            while n > 0:
                chosen, used = [], {}
                for c in usable[j]:  # the largest left of each class
                    s = stock.largest(top[c])
                    while s and cls[s] == c and stock.left[s] <= used.get(s, 0):
                        s = stock.largest(s - 1)
                    if not s or cls[s] != c:
                        break
                    chosen.append(s)
                    used[s] = used.get(s, 0) + 1
                if len(chosen) < len(usable[j]):
                    break
                k = stock.take(used, n)
                whole.append((chosen, k))
                n -= k
    # what the patterns leave open is filled first, then whole containers from the rest
    for chosen, n in whole:
        while n > 0:
            used: dict[int, int] = {}
            added = stock.fill(used, capacity - sum(chosen))
            k = stock.take(used, n)
            out.append(((*chosen, *added), k))
            n -= k
    while first := stock.largest(capacity):
        used = {first: 1}
        added = stock.fill(used, capacity - first)
        out.append(((first, *added), stock.take(used, stock.left[first])))
    return out


class Places:
    """Where the r-th item of a size goes, for one container size; as long as the plan, not the data."""

    def __init__(self, planned: list[tuple[tuple[int, ...], int]]) -> None:
        rows: dict[int, list[tuple[int, int, int]]] = {}
        rank: dict[int, int] = {}
        container = 0
        for sizes, n in planned:
            for s in dict.fromkeys(sizes):
                per = sizes.count(s)
                rows.setdefault(s, []).append((rank.get(s, 0), per, container))
                rank[s] = rank.get(s, 0) + per * n
            container += n
        self.rows = {s: tuple(np.array(x, np.int64) for x in zip(*r)) for s, r in rows.items()}
        self.n_containers = container

    def find(self, size: int, ranks: np.ndarray) -> np.ndarray:
        first, per, container = self.rows[size]
        at = np.searchsorted(first, ranks, side="right") - 1
        return container[at] + (ranks - first[at]) // per[at]


def capacities(specs: DataFrame) -> dict[str, int]:
    """The kinds of container, which are given by hand; those without a positive capacity are left out."""
    rows = specs.where("capacity_tokens > 0 and spec_name is not null").groupBy("spec_name").agg(F.max("capacity_tokens").alias("c")).collect()
    return {r["spec_name"]: int(r["c"]) for r in rows}


def pieces(sized: DataFrame, caps: dict[str, int]) -> DataFrame:
    """spec_name, doc_id, piece_no, token_start, size: each text once, or cut where it alone exceeds the capacity."""
    kinds = F.array(*[F.struct(F.lit(s).alias("spec_name"), F.lit(c).cast("long").alias("cap")) for s, c in sorted(caps.items())])
    rows = sized.where("tokens > 0").select("doc_id", "tokens", F.explode(kinds).alias("k")).select("doc_id", "tokens", "k.spec_name", "k.cap")
    cut = rows.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.ceil(F.col("tokens") / F.col("cap")).cast("int") - 1)))
    start = F.col("piece_no").cast("long") * F.col("cap")
    return cut.select("spec_name", "doc_id", "piece_no", start.alias("token_start"), F.least(F.col("cap"), F.col("tokens") - start).alias("size"))


def pack(sized: DataFrame, specs: DataFrame, grid: int = GRID) -> DataFrame:
    """The container of each piece of each text, for each kind of container.

    sized: doc_id, tokens. Texts without tokens take no space and have no row;
    nulls count as none. Texts within the capacity are never cut. Specs
    without a positive capacity are left out; of repeated specs one counts.
    """
    caps = capacities(specs)
    if not caps:
        return sized.sparkSession.createDataFrame([], PLACED)
    items = materialize(pieces(sized, caps), "items", n=F.lit(1))

    def planned(own: pd.DataFrame) -> pd.DataFrame:
        spec = own["spec_name"].iloc[0]
        counts = np.zeros(caps[spec] + 1, np.int64)
        counts[own["size"].to_numpy()] = own["n"].to_numpy()
        rows = [(spec, i, list(sizes), n) for i, (sizes, n) in enumerate(plan(counts, caps[spec], grid))]
        return pd.DataFrame(rows, columns=["spec_name", "place", "sizes", "n"])

    histogram = items.groupBy("spec_name", "size").agg(F.count(F.lit(1)).alias("n"))  # a group is at most one row a size
    each = histogram.repartition(len(caps), "spec_name").groupBy("spec_name").applyInPandas(planned, "spec_name string, place long, sizes array<long>, n long").orderBy("place").collect()
    places = {spec: Places([(tuple(r["sizes"]), r["n"]) for r in each if r["spec_name"] == spec]) for spec in caps}
    shared = sized.sparkSession.sparkContext.broadcast(places)
    buckets = max(1, written_sums(items)["n"] // 50_000)
    keyed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("spec_name", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("spec_name", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    ranked = keyed.withColumn("own", F.row_number().over(Window.partitionBy("spec_name", "size", "bucket").orderBy("doc_id", "piece_no")) - 1).join(before, ["spec_name", "size", "bucket"]).withColumn("rank", F.col("own") + F.col("before"))

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = np.zeros(len(part), np.int64)
            for (spec, size), at in part.groupby(["spec_name", "size"]).indices.items():
                out[at] = shared.value[spec].find(size, part["rank"].to_numpy()[at])
            yield pd.DataFrame({"spec_name": part["spec_name"], "container_id": out, "doc_id": part["doc_id"], "piece_no": part["piece_no"], "token_start": part["token_start"], "token_end": part["token_start"] + part["size"]})

    return ranked.select("spec_name", "size", "rank", "doc_id", "piece_no", "token_start").mapInPandas(place, PLACED)


def fill_report(placed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per kind of container: how many, how full, how many pieces and cut texts."""
    used = placed.groupBy("spec_name", "container_id").agg(F.sum(F.col("token_end") - F.col("token_start")).alias("used"), F.count(F.lit(1)).alias("n"), F.sum((F.col("piece_no") > 0).cast("int")).alias("cuts"))
    caps = specs.where("capacity_tokens > 0").groupBy("spec_name").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return used.groupBy("spec_name").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_pieces"), F.sum("cuts").alias("n_cuts"), F.sum("used").alias("used_tokens"), F.max("used").alias("fullest")).join(caps, "spec_name").withColumn("fill_share", F.col("used_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))
