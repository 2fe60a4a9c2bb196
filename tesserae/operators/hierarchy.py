"""Parent-child links to full hierarchies: path, depth, root, descendants, cycles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tesserae.functions.titles import title_key
from tesserae.operators.skew import skew_lookup
from tesserae.session import drop_materialized, materialize, written_sums

WALKED = "node long, parent long, root_id long, depth int, path array<long>, hook long, n_descendants long, node_state string"


def components(nodes: DataFrame) -> DataFrame:
    """node, parent, comp, on_ring, depth for nodes(node, parent), in which parents are nodes or null.

    Pointer doubling, one join a round and as many rounds as the logarithm of
    the depth. comp is the root of a tree; else the smallest node of the cycle,
    and depth, the steps up to the root, is null. In a round in which no node
    reaches a root, all that are left lead into cycles: trees of a greater
    depth hold nodes of every lesser one. There the pointers' targets are the
    cycles' members once they get no fewer, and a member has seen its whole
    cycle once no node sees a smaller one.
    """
    first = F.col("parent").isNull()
    state = nodes.select("node", "parent", F.coalesce("parent", "node").alias("ptr"), F.when(first, 0).otherwise(1).cast("long").alias("depth"), F.col("node").alias("least"), first.alias("done"), F.lit(False).alias("changed"))
    state = materialize(state, "doubling", left=~F.col("done"), changed=F.col("changed"))
    left, image = written_sums(state)["left"], -1
    while left:
        step = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("depth").alias("more"), F.col("least").alias("other"), F.col("done").alias("end"))
        moved = skew_lookup(state.where("not done").select("node", "parent", "ptr", "depth", "least"), step, ["ptr"], "inner", rows=left)
        moved = moved.select("node", "parent", F.col("next").alias("ptr"), (F.col("depth") + F.col("more")).alias("depth"), F.least("least", "other").alias("least"), F.col("end").alias("done"), (F.col("other") < F.col("least")).alias("changed"))
        after = materialize(state.where("done").unionByName(moved), "doubling", left=~F.col("done"), changed=F.col("changed") & ~F.col("done"))
        drop_materialized(state)
        before, last, state = left, image, after
        left = written_sums(state)["left"]
        if left == before:
            image = state.where("not done").select("ptr").distinct().count()
            if image == last and not written_sums(state)["changed"]:
                break
    trees = state.where("done").select("node", "parent", F.col("ptr").alias("comp"), F.lit(False).alias("on_ring"), F.col("depth").cast("int").alias("depth"))
    if not left:
        return trees
    loops = state.where("not done")
    members = loops.select(F.col("ptr").alias("node")).distinct().withColumn("member", F.lit(True))
    loops = loops.select("node", "parent", "ptr", "least").join(members, "node", "left")
    comps = loops.where("member").select(F.col("node").alias("ptr"), F.col("least").alias("comp"))
    loops = skew_lookup(loops, comps, ["ptr"], "inner", rows=left).select("node", "parent", "comp", F.coalesce("member", F.lit(False)).alias("on_ring"), F.lit(None).cast("int").alias("depth"))
    return trees.unionByName(loops)


def _visits(rows: pd.DataFrame) -> Iterator[tuple]:
    """Iterative depth-first traversal, with node colouring, of whole fragments: a row of WALKED for each node as it turns black."""
    nodes = rows["node"].tolist()
    up = dict(zip(nodes, (None if pd.isna(p) else int(p) for p in rows["up"])))
    hook = dict(zip(nodes, (None if pd.isna(p) else int(p) for p in rows["hook"])))
    comp, base, looped = (dict(zip(nodes, rows[c].tolist())) for c in ("comp", "base", "looped"))
    below: dict[int, list[int]] = {}
    for n, p in up.items():
        if p is not None:
            below.setdefault(p, []).append(n)
    white, grey, black = 0, 1, 2
    colour = dict.fromkeys(nodes, white)
    count = dict.fromkeys(nodes, 0)

    def descend(start: int, state: str, trail: list[int], ring: frozenset, first: int) -> Iterator[tuple]:
        root, hang = comp[start], hook[start]
        stack = [(start, iter(below.get(start, ())))]
        colour[start] = grey
        while stack:
            node, kids = stack[-1]
            for k in kids:
                if k in ring or colour[k] == grey:  # a back edge closes a cycle
                    continue
                colour[k] = grey
                trail.append(k)
                stack.append((k, iter(below.get(k, ()))))
                break
            else:
                colour[node] = black
                stack.pop()
                yield node, up[node] if hang is None or node != start else hang, root, first + len(trail) - 1, list(trail), hang, count[node], state
                if stack:
                    trail.pop()
                    count[stack[-1][0]] += count[node] + 1

    for n in nodes:
        if up[n] is None:
            yield from descend(n, "below_cycle" if looped[n] else "tree", [n], frozenset(), base[n])
    for n in nodes:
        if colour[n] == white:  # leads into a cycle; walk up until a node seen before shows the back edge
            seen: dict[int, None] = {}
            at = n
            while colour[at] == white and at not in seen:
                seen[at] = None
                at = up[at]
            if at in seen:
                order = list(seen)
                ring = order[order.index(at) :]
                members = frozenset(ring)
                for m in ring:
                    colour[m] = grey
                hang = 0
                for m in ring:
                    for k in below.get(m, ()):
                        if k not in members:
                            yield from descend(k, "below_cycle", [m, k], members, 0)
                            hang += count[k] + 1
                for m in ring:
                    colour[m] = black
                    yield m, up[m], comp[m], 0, [m], None, hang + len(ring) - 1, "cycle"


def _walk(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The fragments of a bucket, given out bit by bit: what is held is the nodes, not their paths."""
    names = [c.split()[0] for c in WALKED.split(", ")]
    out: list[tuple] = []
    size = 0

    def frame() -> pd.DataFrame:
        return pd.DataFrame(out, columns=names).astype({"parent": "Int64", "hook": "Int64"})

    for row in _visits(pd.concat(list(parts), ignore_index=True)):
        out.append(row)
        size += len(row[4]) + 8
        if size > 500_000:
            yield frame()
            out, size = [], 0
    yield frame()


def subtrees(forest: DataFrame) -> DataFrame:
    """node, depth, below, weight for forest(node, up): steps up to the root, nodes below it, and the sum of their depths, itself included, as seen from it, 1 for itself.

    Doubling again: what stands less than 2^k steps below a node is summed into
    its 2^k-th ancestor, by aggregates that shrink hot nodes before the shuffle.
    """
    has = F.col("ptr").isNotNull()
    state = materialize(forest.select("node", F.col("up").alias("ptr"), F.col("up").isNotNull().cast("int").alias("depth"), F.lit(1).cast("long").alias("size"), F.lit(1).cast("long").alias("weight")), "subtrees", left=has)
    reach = 1
    while written_sums(state)["left"]:
        gain = state.where("ptr is not null").groupBy(F.col("ptr").alias("node")).agg(F.sum("size").alias("more"), F.sum("weight").alias("heavier"))
        step = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("depth").alias("above"))
        moved = skew_lookup(state, step, ["ptr"], "left", rows=written_sums(state)["left"]).join(gain, "node", "left")
        more = F.coalesce("more", F.lit(0))
        state_next = materialize(moved.select("node", F.col("next").alias("ptr"), F.when(has, F.lit(reach) + F.col("above")).otherwise(F.col("depth")).cast("int").alias("depth"), (F.col("size") + more).alias("size"), (F.col("weight") + F.coalesce("heavier", F.lit(0)) + more * reach).alias("weight")), "subtrees", left=has)
        drop_materialized(state)
        state, reach = state_next, reach * 2
    return state.select("node", "depth", (F.col("size") - 1).alias("below"), "weight")


def _heads(light: DataFrame) -> DataFrame:
    """node, head: the highest of the nodes(node, up) above each, by pointer doubling."""
    state = materialize(light.select("node", F.coalesce("up", "node").alias("ptr"), F.col("up").isNull().alias("done")), "heads", left=~F.col("done"))
    while written_sums(state)["left"]:
        step = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("done").alias("end"))
        moved = skew_lookup(state.where("not done").select("node", "ptr"), step, ["ptr"], "inner", rows=written_sums(state)["left"]).select("node", F.col("next").alias("ptr"), F.col("end").alias("done"))
        after = materialize(state.where("done").unionByName(moved), "heads", left=~F.col("done"))
        drop_materialized(state)
        state = after
    return state.select("node", F.col("ptr").alias("head"))


def _skeleton_paths(skeleton: DataFrame) -> DataFrame:
    """node, path of skeleton(node, up), from the root down: doubling, with the arrays joined."""
    state = materialize(skeleton.select("node", F.col("up").alias("ptr"), F.array("node").alias("path")), "paths", left=F.col("ptr").isNotNull())
    while written_sums(state)["left"]:
        step = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("path").alias("above"))
        moved = skew_lookup(state, step, ["ptr"], "left").select("node", F.col("next").alias("ptr"), F.concat(F.coalesce("above", F.array().cast("array<bigint>")), "path").alias("path"))
        state = materialize(moved, "paths", left=F.col("ptr").isNotNull())
    return state.select("node", "path")


def _fragments(heavy: DataFrame, most: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components that weigh more than `most`, cut: the fragments to walk, the skeleton's rows, and its links(node, up).

    A node is light if the paths below it, from it on, hold at most `most`
    nodes together. Light nodes below a heavy one, with all below them, are
    the fragments; heavy nodes and members of cycles are the skeleton, whose
    numbers the sums over subtrees give.
    """
    forest = heavy.select("node", "parent", "comp", "on_ring", "n", "looped", F.when(~F.col("on_ring"), F.col("parent")).alias("up"))
    known = materialize(forest.join(subtrees(forest.select("node", "up")), "node").withColumn("light", (F.col("weight") <= most) & ~F.col("on_ring")), "cut")
    above = known.select(F.col("node").alias("up"), F.col("light").alias("up_light"))
    light = materialize(skew_lookup(known.where("light"), above, ["up"], "left").withColumn("top", ~F.coalesce("up_light", F.lit(False))), "light")
    heads = _heads(light.select("node", F.when(~F.col("top"), F.col("up")).alias("up")))
    own = light.join(heads, "node")
    tops = light.where("top").select(F.col("node").alias("head"), F.col("parent").alias("hook"), F.col("depth").alias("base"))
    walk = skew_lookup(own.select("node", "head", "comp", "looped", F.when(~F.col("top"), F.col("parent")).alias("up")), tops, ["head"], "inner")
    walk = walk.select("node", "up", "comp", F.col("head").alias("fragment"), "hook", "base", "looped")
    ring = F.col("on_ring")
    rest = known.where("not light")
    rows = rest.select("node", "parent", F.col("comp").alias("root_id"), "depth", F.lit(None).cast("array<bigint>").alias("path"), F.col("node").alias("hook"), F.when(ring, F.col("n") - 1).otherwise(F.col("below")).alias("n_descendants"), F.when(ring, "cycle").when(F.col("looped"), "below_cycle").otherwise("tree").alias("node_state"))
    return walk, rows, rest.select("node", "up")


def hierarchy(nodes: DataFrame, most: int = 8_000_000, together: int = 1_000_000, paths: bool = True) -> DataFrame:
    """Path, depth, root, number of descendants and state of every node.

    nodes(node long, parent long): one row a node; a parent that is no node is
    no parent. Components are found by pointer doubling and brought together,
    about `together` path nodes a task, where a depth-first traversal with node
    colouring gives the rest. What a task gets of one component is bounded by
    the length of its paths: components that weigh more than `most` path nodes
    are cut into fragments that do not, which are walked in the same way and
    hang from a skeleton whose numbers are sums. path runs from the root (or
    from the cycle's member) to the node; without paths the column is left
    out, and what was walked is the same. A cycle's member has depth 0, its
    root_id is the smallest member and its descendants are the rest of the
    cycle and all below it. Repeated rows count once, of several parents the
    smallest counts; null nodes are dropped; an empty table gives no rows.
    """
    own = nodes.select("node", "parent").where("node is not null").groupBy("node").agg(F.min("parent").alias("parent"))
    own = materialize(own, "nodes", n=F.lit(1))
    count = written_sums(own)["n"]
    known = own.select(F.col("node").alias("parent"), F.lit(True).alias("known"))
    own = skew_lookup(own, known, ["parent"], "left", rows=count).select("node", F.when(F.col("known"), F.col("parent")).alias("parent"))
    comp = materialize(components(own), "components")
    n = F.count(F.lit(1))
    sizes = comp.groupBy("comp").agg(n.alias("n"), F.bool_or("on_ring").alias("looped"), F.coalesce(F.sum(F.col("depth") + 1), n * (n + 1) / 2).cast("long").alias("weight"))
    heavy = F.col("weight") > most
    sizes = materialize(sizes, "sizes", heavy=heavy, total=F.when(~heavy, F.col("weight")))
    whole = skew_lookup(comp, sizes, ["comp"], "inner", rows=count)
    none = F.lit(None).cast("long")
    walk = whole.where(~heavy).select("node", F.col("parent").alias("up"), "comp", F.col("comp").alias("fragment"), none.alias("hook"), F.lit(0).alias("base"), F.lit(False).alias("looped"))
    total, rest = written_sums(sizes)["total"], None
    if written_sums(sizes)["heavy"]:
        pieces, rest, links = _fragments(materialize(whole.where(heavy), "heavy"), most)
        pieces = materialize(pieces, "pieces", n=F.lit(1))
        total += 2 * written_sums(pieces)["n"]
        walk = walk.unionByName(pieces)
    buckets = max(1, min(total // together, 1 << 20), min(8, total // 20_000))
    walk = walk.withColumn("bucket", F.pmod(F.xxhash64("fragment"), F.lit(buckets)).cast("int")).repartition(int(min(buckets, 10_000)), "bucket")
    walked = walk.groupBy("bucket").applyInPandas(_walk, WALKED)
    if rest is not None:
        walked = walked.unionByName(rest)
    if rest is None or not paths:
        return walked.drop("hook") if paths else walked.drop("hook", "path")
    above = _skeleton_paths(links).select(F.col("node").alias("hook"), F.col("path").alias("above"))
    nothing = F.array().cast("array<bigint>")
    return skew_lookup(walked, above, ["hook"], "left").withColumn("path", F.concat(F.coalesce("above", nothing), F.coalesce("path", nothing))).select("node", "parent", "root_id", "depth", "path", "n_descendants", "node_state")


def category_nodes(page: DataFrame, categorylinks: DataFrame) -> DataFrame:
    """node and parent of every category page, by the title rule.

    Of pages that share a title key the one with the smallest id stands for it.
    """
    cats = page.where("page_namespace = 14 and page_id is not null").select("page_id", title_key(F.col("page_title")).alias("key"))
    ids = cats.select(F.col("page_id").alias("node")).distinct()
    by_title = cats.where("key is not null").groupBy("key").agg(F.min("page_id").alias("parent"))
    links = categorylinks.where("cl_from is not null and cl_to is not null").select(F.col("cl_from").alias("node"), title_key(F.col("cl_to"), category=True).alias("key"))
    child = materialize(links.join(ids, "node", "left_semi").where("key is not null").distinct(), "children", n=F.lit(1))
    linked = skew_lookup(child, by_title, ["key"], "inner", rows=written_sums(child)["n"]).groupBy("node").agg(F.min("parent").alias("parent"))
    return ids.join(linked, "node", "left")


def _ring_places(ring: DataFrame) -> DataFrame:
    """node, root_id, place, length, size of each cycle's member: its steps up to the smallest one, and how many nodes there are on the cycle and in all.

    Pointer doubling along the cycle cut at its smallest member, so the
    logarithm of its length in rounds.
    """
    least = F.col("node") == F.col("root_id")
    state = ring.select("node", "root_id", F.when(least, F.col("node")).otherwise(F.col("parent")).alias("ptr"), F.when(least, 0).otherwise(1).cast("long").alias("place"))
    state = materialize(state, "places")
    while not (active := state.where("ptr <> root_id")).isEmpty():
        step = state.select(F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("place").alias("more"))
        moved = active.join(step, "ptr").select("node", "root_id", F.col("next").alias("ptr"), (F.col("place") + F.col("more")).alias("place"))
        state = materialize(state.where("ptr = root_id").unionByName(moved), "places")
    sizes = ring.groupBy("root_id").agg(F.count(F.lit(1)).alias("length"), (F.max("n_descendants") + 1).alias("size"))
    return materialize(skew_lookup(state.drop("ptr"), sizes, ["root_id"], "inner"), "places")


def descendants(tree: DataFrame, together: int = 1_000_000) -> DataFrame:
    """ancestor_id, descendant_id, distance for every pair; as many of an ancestor as its n_descendants.

    distance is the least number of steps up. Pairs on a path are read off it.
    Below a cycle, paths begin at the member they hang from; the other members
    of the cycle are ancestors too, of its members and of all below them: they
    are joined on root_id, about `together` pairs to a salt. No node is its own
    descendant.
    """
    tree = materialize(tree, "tree")
    steps = tree.select(F.col("node").alias("descendant_id"), F.col("depth"), F.posexplode("path").alias("at", "ancestor_id")).where("at < depth")
    pairs = steps.select("ancestor_id", "descendant_id", (F.col("depth") - F.col("at")).cast("int").alias("distance"))
    ring = tree.where("node_state = 'cycle' and node <> parent")
    if ring.isEmpty():
        return pairs
    places = _ring_places(ring.select("node", "parent", "root_id", "n_descendants"))
    salts = F.least(F.lit(1024), 1 + F.floor(F.col("size") * F.col("length") / together)).cast("int")
    entries = places.select(F.col("node").alias("entry"), F.col("place").alias("entry_place"), "length", "size")
    hung = tree.where("node_state <> 'tree'").select(F.col("node").alias("descendant_id"), "root_id", "depth", F.col("path")[0].alias("entry"))
    hung = skew_lookup(hung, entries, ["entry"], "inner").withColumn("salt", F.pmod(F.xxhash64("descendant_id"), salts).cast("int"))
    others = places.select(F.col("node").alias("ancestor_id"), "root_id", "place", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    around = F.pmod(F.col("entry_place") - F.col("place"), F.col("length"))
    return pairs.unionByName(hung.join(others, ["root_id", "salt"]).where(around > 0).select("ancestor_id", "descendant_id", (F.col("depth") + around).cast("int").alias("distance")))
