"""Near-duplicate embeddings by dual traversal of cover trees.

Vectors are scaled to length one; cosine >= c is distance <= t = sqrt(2 - 2c). A tree has nested levels of
centres with halving radii (2, 1, 0.5, ... down to the last radius that is at least t): the centres of a level
stay centres below, lie further apart than the level's radius, and cover all points within it. Every
node knows its true covering radius; children of a node, and the points below it, are one range. Two trees are
traversed together: a pair of nodes is given up when the distance of the centres exceeds both covering radii
plus t, and taken whole when that distance and both radii together stay below t; what is left at the
leaves is compared in double precision, so exactly the pairs at the threshold are found.

Pairs of nodes go down in portions, all at once: few children are paired by repetition, many by tiles of a matrix
product whose rows carry the radii too, so that its sign is the bound.

Over a cluster the top of the tree is laid on a bounded sample (TOP_SAMPLE vectors; it only places cells and
cannot change results): every vector goes to its nearest top centre, large cells are split into parts of
about CELL vectors, and every part becomes a tree in one task. Trees are put together in groups, at least GROUPS
of them where there are as many trees; pairs of groups whose bounds are too far apart are left out, each
other pair is one task's work. The driver holds a centre and a radius for each group (at most one for GROUP_TREES
trees) and their pairs. Equal vectors are one point with a count. A task returns for each point how many
vectors it links to and its root in a spanning forest, never pairs.

In many dimensions without structure no metric bound prunes, and the work is quadratic in the
number of distinct vectors (blocks of float32 products); the README has figures.

Defined results for odd input: vectors that are null, zero or hold null or non-finite components link with
nothing (n_links 0, own component); vectors of different lengths never link; repeated vec_ids are rows
of their own in the counts; a null vec_id gets component null and counts as a link of others; other columns are passed over.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.graph import connected_components
from quarry.llm.simhash import forest
from quarry.session import ship, staged, table

COSINE = 0.9
CELL = 8192
TOP_SAMPLE = 2048
TOP_CENTRES = 64
#: Groups of trees to aim at, and the most trees of one group (a task holds two groups).
GROUPS, GROUP_TREES = 64, 32
#: Rows of a block of distances, and pairs compared at once in double precision.
ROWS, PAIRS = 512, 100_000
#: Children a node of a level must have on average for the level to be kept.
BRANCH = 1.5
#: Children of a pair of nodes from which a matrix product compares them.
TILE = 4096
#: Above the rounding of float32 distances; pruning is never closer than this.
SLACK = 2e-3


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, safe for very large and very small components."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def net(x: np.ndarray, centres: np.ndarray, radius: float) -> np.ndarray:
    """centres plus greedily chosen points, until every point lies within radius of one (float32 rounding aside)."""
    least = np.float32(1 - radius * radius / 2)  # dot product at that distance
    found = list(centres)
    rest = np.setdiff1d(np.arange(len(x)), centres)
    for s in range(0, len(rest), ROWS):
        some = rest[s : s + ROWS]
        if found:
            some = some[(x[some] @ x[found].T).max(1) < least]
        near = x[some] @ x[some].T >= least
        free = np.ones(len(some), bool)
        for i in range(len(some)):
            if free[i]:
                found.append(some[i])
                free &= ~near[i]
    return np.array(found, np.int64)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([(x[a : a + ROWS] @ c.T).argmax(1) for a in range(0, len(x), ROWS)]) if len(x) else np.zeros(0, np.int64)


def _placed(x: np.ndarray, points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each of the points its place among the centres: a centre's own, else that of the nearest."""
    place = np.full(len(x), -1, np.int64)
    place[centres] = np.arange(len(centres))
    out = place[points]
    rest = np.flatnonzero(out < 0)
    out[rest] = nearest(x[points[rest]], x[centres])
    return out


def build(x: np.ndarray, reach: float) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The cover tree of unit vectors: the points' new order, and for each level its centres (in that order), covering radii,
    first child of each node in the level below and first point below each node."""
    x32 = x.astype(np.float32)
    levels, r, centres = [], 2.0, np.zeros(0, np.int64)
    while True:
        centres = net(x32, centres, r)
        levels.append(centres)
        if r / 2 < reach:
            break
        r /= 2
    # As in a compressed tree, a level that hardly branches is passed over: its nodes have nearly all the one child that is
    # their own centre, at a smaller radius.
    levels = [c for c, below in zip(levels, [*levels[1:], None], strict=True) if below is None or len(below) >= BRANCH * len(c)]
    ups = [np.zeros(len(levels[0]), np.int64)]
    for k in range(1, len(levels)):
        # Nodes are numbered so that children of a node follow each other.
        up = _placed(x32, levels[k], levels[k - 1])
        by = np.argsort(up, kind="stable")
        levels[k] = levels[k][by]
        ups.append(up[by])
    leaf = _placed(x32, np.arange(len(x)), levels[-1])
    order = np.argsort(leaf, kind="stable")
    leaf = leaf[order]
    moved = np.empty(len(x), np.int64)
    moved[order] = np.arange(len(x))
    x = x[order]
    out: dict[str, np.ndarray] = {"depth": np.array(len(levels))}
    below = leaf
    for k in range(len(levels) - 1, -1, -1):
        centre = moved[levels[k]]
        apart = np.sqrt(np.maximum(0, ((x - x[centre[below]]) ** 2).sum(1)))
        radius = np.zeros(len(centre))
        np.maximum.at(radius, below, apart)
        out[f"centre{k}"], out[f"radius{k}"] = centre.astype(np.int32), radius
        out[f"point{k}"] = np.searchsorted(below, np.arange(len(centre) + 1)).astype(np.int32)
        if k:
            out[f"child{k - 1}"] = np.searchsorted(ups[k], np.arange(len(levels[k - 1]) + 1)).astype(np.int32)
            below = ups[k][below]
    return order, out


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of ranges, one range after another."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _products(first_a: np.ndarray, na: np.ndarray, first_b: np.ndarray, nb: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of two ranges each, in portions of about PAIRS."""
    many = na * nb
    part = np.cumsum(many) // PAIRS
    for s, e in zip(np.flatnonzero(np.diff(part, prepend=-1)), [*np.flatnonzero(np.diff(part)) + 1, len(many)], strict=True):
        n, w = many[s:e], np.repeat(nb[s:e], many[s:e])
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield np.repeat(first_a[s:e], n) + at // w, np.repeat(first_b[s:e], n) + at % w


def deepened(tree: dict[str, np.ndarray], depth: int) -> dict[str, np.ndarray]:
    """The tree with its leaves repeated, each as its own only child, until it has depth levels."""
    tree = dict(tree)
    for k in range(int(tree["depth"]), depth):
        for name in ("centre", "radius", "point"):
            tree[f"{name}{k}"] = tree[f"{name}{k - 1}"]
        tree[f"child{k - 1}"] = np.arange(len(tree[f"centre{k}"]) + 1)
        tree["depth"] = np.array(k + 1)
    return tree


class Dual:
    """The traversal of two trees, or of one against itself (then each pair of points comes once, and none with itself)."""

    def __init__(self, xa: np.ndarray, ta: dict, xb: np.ndarray, tb: dict, cosine: float, same: bool):
        ta, tb = deepened(ta, int(tb["depth"])), deepened(tb, int(ta["depth"]))
        self.xa, self.ta, self.xb, self.tb, self.cosine, self.same = xa, ta, xb, tb, cosine, same
        self.fa, self.fb = xa.astype(np.float32), xb.astype(np.float32)
        self.t = float(np.sqrt(2 - 2 * cosine))
        self.depth = int(ta["depth"])

    def _bound(self, k: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose products are at least zero where a pair of nodes cannot be given up: the distance's square is
        2 - 2ab, and (p + r)^2 with p = radius of a + reach, r = radius of b is a product too."""
        p, r = self.ta[f"radius{k}"][a] + self.t + SLACK, self.tb[f"radius{k}"][b]
        one = np.ones
        left = np.column_stack((self.fa[self.ta[f"centre{k}"][a]], p, p * p / 2 - 1, one(len(a)))).astype(np.float32)
        right = np.column_stack((self.fb[self.tb[f"centre{k}"][b]], r, one(len(b)), r * r / 2)).astype(np.float32)
        return left, right

    def _tiles(self, k: int, a0: int, a1: int, b0: int, b1: int, self_pair: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of the nodes a0..a1 and b0..b1 of level k that the bound leaves."""
        left, right = self._bound(k, np.arange(a0, a1), np.arange(b0, b1))
        for s in range(0, a1 - a0, ROWS):
            skip = s if self_pair else 0
            hit = np.flatnonzero(left[s : s + ROWS] @ right[skip:].T >= 0)
            i, j = a0 + s + hit // (b1 - b0 - skip), b0 + skip + hit % (b1 - b0 - skip)
            if self_pair:
                i, j = i[i <= j], j[i <= j]
            yield i, j

    def nodes(self) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
        """Pairs of nodes: ("all", level, a, b) whose points all link, ("leaf", level, a, b) to be compared."""
        ta, tb = self.ta, self.tb

        def sift(k: int, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[str, int, np.ndarray, np.ndarray]]:
            if not len(i):
                return
            ra, rb = ta[f"radius{k}"][i], tb[f"radius{k}"][j]
            far = np.sqrt(np.maximum(0, ((self.xa[ta[f"centre{k}"][i]] - self.xb[tb[f"centre{k}"][j]]) ** 2).sum(1)))
            whole = far + ra + rb <= self.t - SLACK
            near = ~whole & (far <= ra + rb + self.t + SLACK)
            if whole.any():
                yield "all", k, i[whole], j[whole]
            i, j = i[near], j[near]
            if not len(i):
                return
            if k + 1 == self.depth:
                yield "leaf", k, i, j
                return
            ca, cb = ta[f"child{k}"].astype(np.int64), tb[f"child{k}"].astype(np.int64)
            na, nb = ca[i + 1] - ca[i], cb[j + 1] - cb[j]
            for m in np.flatnonzero(na * nb > TILE):
                for u, v in self._tiles(k + 1, ca[i[m]], ca[i[m] + 1], cb[j[m]], cb[j[m] + 1], self.same and i[m] == j[m]):
                    for s in range(0, len(u), PAIRS):
                        yield from sift(k + 1, u[s : s + PAIRS], v[s : s + PAIRS])
            few = np.flatnonzero(na * nb <= TILE)
            if len(few):
                for u, v in _products(ca[i[few]], na[few], cb[j[few]], nb[few]):
                    if self.same:  # a node's children number on, so this is only within a node's own pair
                        u, v = u[u <= v], v[u <= v]
                    yield from sift(k + 1, u, v)

        n, m = len(ta["centre0"]), len(tb["centre0"])
        for i, j in self._tiles(0, 0, n, 0, m, self.same):
            yield from sift(0, i, j)

    def compared(self, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of points of leaves at the threshold."""

        def exact(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            if self.same:
                u, v = u[u < v], v[u < v]
            ok = np.einsum("ij,ij->i", self.xa[u], self.xb[v]) >= self.cosine
            return u[ok], v[ok]

        k = self.depth - 1
        pa, pb = self.ta[f"point{k}"].astype(np.int64), self.tb[f"point{k}"].astype(np.int64)
        na, nb = pa[i + 1] - pa[i], pb[j + 1] - pb[j]
        for m in np.flatnonzero(na * nb > TILE):
            b0, b1 = pb[j[m]], pb[j[m] + 1]
            for s in range(pa[i[m]], pa[i[m] + 1], ROWS):
                # The product only finds what may be near; the same sum as elsewhere decides.
                hit = np.flatnonzero(self.fa[s : min(s + ROWS, pa[i[m] + 1])] @ self.fb[b0:b1].T >= np.float32(self.cosine - 1e-4))
                u, v = s + hit // (b1 - b0), b0 + hit % (b1 - b0)
                for p in range(0, len(u), PAIRS):
                    yield exact(u[p : p + PAIRS], v[p : p + PAIRS])
        few = np.flatnonzero(na * nb <= TILE)
        if len(few):
            for u, v in _products(pa[i[few]], na[few], pb[j[few]], nb[few]):
                yield exact(u, v)


def packed(ids: np.ndarray, counts: np.ndarray, x: np.ndarray, tree: dict) -> bytes:
    out = io.BytesIO()
    x32 = x.astype(np.float32)
    np.savez(out, ids=ids, counts=counts, x=x32 if (x32 == x).all() else x, **{f"t_{k}": v for k, v in tree.items()})
    return out.getvalue()


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """Ids, counts, unit vectors and the tree."""
    z = np.load(io.BytesIO(blob), allow_pickle=False)
    return z["ids"], z["counts"], unit(z["x"]), {k[2:]: z[k] for k in z.files if k.startswith("t_")}


def compare(a: tuple, b: tuple | None, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Link counts and forest roots of the points of two unpacked trees (or of one with itself): ids, links, roots."""
    ia, ca, xa, ta = a
    ib, cb, xb, tb = b if b is not None else a
    ids, counts = (ia, ca) if b is None else (np.concatenate((ia, ib)), np.concatenate((ca, cb)))
    shift = 0 if b is None else len(ia)
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    more = np.zeros(len(ids) + 1, np.int64)  # links of ranges of points, at the ranges' ends
    weight = np.concatenate(([0], np.cumsum(counts)))
    whole: dict[int, list] = {}

    def tie(i: np.ndarray, j: np.ndarray) -> None:
        nonlocal root
        child, up = forest(ids, np.concatenate((i, np.arange(len(ids)))), np.concatenate((j, root)))
        root = np.arange(len(ids))
        root[child] = up

    dual = Dual(xa, ta, xb, tb, cosine, b is None)
    ta, tb = dual.ta, dual.tb
    for kind, k, i, j in dual.nodes():
        if kind == "leaf":
            for u, v in dual.compared(i, j):
                v = v + shift
                np.add.at(links, u, counts[v])
                np.add.at(links, v, counts[u])
                if len(u):
                    tie(u, v)
            continue
        whole.setdefault(k, []).append((i, j))
    for k, some in whole.items():
        i, j = (np.concatenate(c) for c in zip(*some, strict=True))
        pa, pb = ta[f"point{k}"].astype(np.int64), tb[f"point{k}"].astype(np.int64) + shift
        own = (i == j) if b is None else np.zeros(len(i), bool)
        for first, node, other_first, other, use in ((pa, i, pb, j, np.ones(len(i), bool)), (pb, j, pa, i, ~own)):
            n = weight[other_first[other + 1]] - weight[other_first[other]]
            np.add.at(more, first[node[use]], n[use])
            np.add.at(more, first[node[use] + 1], -n[use])
        inside = np.unique(i[own])
        within = _ranges(pa[inside], pa[inside + 1] - pa[inside])
        links[within] -= counts[within]
        # All points of a node hang on its first one.
        for first, nodes in ((pa, np.unique(i)), (pb, np.unique(j))):
            n = first[nodes + 1] - first[nodes]
            tie(_ranges(first[nodes], n), np.repeat(first[nodes], n))
        tie(pa[i], pb[j])
    links += np.cumsum(more)[:-1]
    hit = np.flatnonzero(links)
    return ids[hit], links[hit], ids[root[hit]]


def _top(sample: np.ndarray, reach: float) -> np.ndarray:
    """The finest level over the sample with at most TOP_CENTRES centres."""
    x, r, centres = sample.astype(np.float32), 2.0, np.zeros(0, np.int64)
    best = np.zeros(1, np.int64)
    while r >= reach / 2:
        centres = net(x, centres, r)
        if len(centres) > TOP_CENTRES:
            break
        best = centres
        r /= 2
    return sample[best]


def links(vectors: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """vectors(point long, n long, embedding, dim, distinct and valid) -> (point, links), edges (src, dst)."""
    spark = vectors.sparkSession
    ship(spark)
    reach = float(np.sqrt(2 - 2 * cosine))
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    held: dict[int, tuple[np.ndarray, int]] = {}
    for dim, n in sizes.items():
        rows = vectors.where(F.col("dim") == dim).orderBy(F.xxhash64("point")).select("embedding").limit(TOP_SAMPLE).collect()
        held[dim] = (_top(unit(np.array([r["embedding"] for r in rows], np.float64)), reach), max(1, -(-n // CELL)))
    tops = spark.sparkContext.broadcast(held)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.empty(len(dims), object)
            values = batch.column("embedding")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = unit(values.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim))
                centres, parts = tops.value[int(dim)]
                for i, c in zip(at, nearest(x.astype(np.float32), centres.astype(np.float32)), strict=True):
                    cells[i] = f"{dim}.{c}"
            yield pa.RecordBatch.from_arrays([batch.column("point"), batch.column("n"), values, pa.array(cells.tolist(), pa.string())], names=["point", "n", "embedding", "cell"])

    celled = staged(vectors.mapInArrow(assign, "point long, n long, embedding array<double>, cell string"), "cells")
    # At most TOP_CENTRES cells for each dimension.
    sizes = {r["cell"]: -(-r["n"] // CELL) for r in celled.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    together = min(GROUP_TREES, max(1, sum(sizes.values()) // GROUPS))
    counted = spark.createDataFrame(list(sizes.items()), "cell string, parts long")
    parts = celled.join(F.broadcast(counted), "cell").withColumn("nth", F.pmod(F.xxhash64("point"), "parts"))

    def tree(key: tuple, got: pa.Table) -> pa.Table:
        cell, nth = key[0].as_py(), key[1].as_py()
        got = got.sort_by("point")
        raw = got.column("embedding").combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
        x = unit(raw)
        order, built = build(x, reach)
        centre = x.mean(0)
        radius = float(np.sqrt(((x - centre) ** 2).sum(1).max()))
        blob = packed(got.column("point").to_numpy()[order], got.column("n").to_numpy()[order], raw[order], built)
        return pa.table({"team": pa.array([f"{cell}.{nth // together}"]), "part": pa.array([f"{cell}.{nth}"]), "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([radius]), "blob": pa.array([blob], pa.binary())})

    trees = staged(parts.groupBy("cell", "nth").applyInArrow(tree, "team string, part string, centre array<double>, radius double, blob binary"), "trees")

    def surround(key: tuple, got: pa.Table) -> pa.Table:
        c = got.column("centre").combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
        mid = c.mean(0)
        return pa.table({"team": pa.array([key[0].as_py()]), "centre": pa.array([mid.tolist()], pa.list_(pa.float64())), "radius": pa.array([float((np.sqrt(((c - mid) ** 2).sum(1)) + got.column("radius").to_numpy()).max())])})

    heads = sorted((r["team"], np.array(r["centre"]), r["radius"]) for r in trees.select("team", "centre", "radius").groupBy("team").applyInArrow(surround, "team string, centre array<double>, radius double").collect())
    sends: list[tuple[str, int]] = []
    number = 0
    for dim in {len(c) for _, c, _ in heads}:
        alike = [h for h in heads if len(h[1]) == dim]
        centres, radii = np.array([c for _, c, _ in alike]), np.array([r for _, _, r in alike])
        for i, (name, c, r) in enumerate(alike):
            for j in i + np.flatnonzero(np.sqrt(((centres[i:] - c) ** 2).sum(1)) <= radii[i:] + r + reach + SLACK):
                sends += [(name, number)] + ([(alike[j][0], number)] if j > i else [])
                number += 1
    if not sends:
        empty = spark.createDataFrame([], "point long, links long, root long")
        return empty.select("point", "links"), empty.select(F.col("point").alias("src"), F.col("root").alias("dst"))
    plan = spark.createDataFrame(sends, "team string, pair long")

    def meet(key: tuple, got: pa.Table) -> pa.Table:
        teams = sorted(set(got.column("team").to_pylist()))
        rows = sorted(zip(got.column("team").to_pylist(), got.column("part").to_pylist(), range(got.num_rows), strict=True))
        held = [(team, np.array(got.column("centre")[k].as_py()), got.column("radius")[k].as_py(), unpacked(got.column("blob")[k].as_py())) for team, _, k in rows]
        found = [(np.zeros(0, np.int64),) * 3]
        for i, (team, c, r, one) in enumerate(held):
            # One group: its trees against each other and themselves; two: the trees of one against those of the other.
            for j in range(i, len(held)):
                if (len(teams) == 1 or held[j][0] != team) and np.sqrt(((c - held[j][1]) ** 2).sum()) <= r + held[j][2] + reach + SLACK:
                    found.append(compare(one, held[j][3] if j > i else None, cosine))
        ids, n, roots = (np.concatenate(c) for c in zip(*found, strict=True))
        return pa.table({"point": pa.array(ids, pa.int64()), "links": pa.array(n, pa.int64()), "root": pa.array(roots, pa.int64())})

    met = trees.join(plan, "team").repartition(max(number, 1) if number < 10_000 else 10_000, "pair").groupBy("pair").applyInArrow(meet, "point long, links long, root long")
    found = staged(met, "links")
    return found.groupBy("point").agg(F.sum("links").alias("links")), found.select(F.col("point").alias("src"), F.col("root").alias("dst"))


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """embeddings(vec_id, embedding) -> vec_id, n_links, component_id, kept."""
    array = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), array.alias("embedding"))
    sound = F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0)
    rows = staged(rows.withColumn("sound", F.coalesce(sound, F.lit(False))).withColumn("key", F.when(F.col("sound"), F.sha2(F.to_json(F.struct("embedding")), 256))), "vectors")
    groups = staged(rows.where("sound").groupBy("key").agg(F.any_value("embedding").alias("embedding"), F.min("vec_id").alias("first_id"), F.count("*").alias("n")).withColumn("point", F.monotonically_increasing_id()), "points")
    counts, edges = links(groups.select("point", "n", "embedding", F.size("embedding").alias("dim")), cosine)
    joined = connected_components(edges)
    named = groups.select("key", "point", "n", "first_id").join(joined.withColumnRenamed("node", "point"), "point", "left").join(counts, "point", "left")
    named = staged(named.select("key", "n", "first_id", F.coalesce("component", "point").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "named")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("key", "n_links", "component_id")
    found = rows.select("vec_id", "key").join(classes, "key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op6_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
pair AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(vec_id, root) AS (SELECT vec_id, vec_id FROM ok UNION SELECT p.b, r.root FROM reach r JOIN pair p ON p.a = r.vec_id),
comp AS (SELECT vec_id, min(root) AS c FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM pair GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, coalesce(c, v.vec_id) AS component_id, coalesce(c, v.vec_id) = v.vec_id AS kept
FROM v LEFT JOIN comp ON comp.vec_id = v.vec_id LEFT JOIN n ON n.vec_id = v.vec_id
"""
