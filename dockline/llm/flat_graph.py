"""Near-duplicate vectors over robust-pruned flat graphs.

Distinct vectors of one label are put into overlapping cells around centroids. In every cell (cut by hash where
it is crowded) a graph is built: each vector keeps neighbours that robust pruning leaves, links go both ways and
everything can be reached from the medoid. A vector's adjacency lists from all its cells are united. A query
visits every block with a cell that can hold a vector in range, by the angles of the cell's vectors and by how far
links were seen to cross borders. Searches run in blocks of neighbouring cells: a greedy beam from the medoids
leads to a query's surroundings, then everything in range and a margin around it is expanded until nothing new is
in range. In every block a fixed number of queries is compared with all vectors, and vectors of the block are
turned and looked for, so that rare links are audited too; while the search finds too few, it is widened. Links
are verified by cosines in double precision, and count in the block of the found vector's nearest cell.

Sizes: centroids come from a bounded sample and are bounded in number, so they are broadcast. A block holds a
bounded number of vectors and of queries, and gives a count per query and a spanning forest of its links,
never the pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockline.llm.common import slices
from dockline.llm.components import connected_components, local_roots
from dockline.session import cut_lineage

RANGE = 0.93
ALPHA = 1.2
DEGREE = 16
STEP = 4          # vectors that a beam expands at a time
MARKS = 1 << 20   # marks (query, vector) of the searches that run side by side


@dataclass(frozen=True)
class Plan:
    """Sizes of the index. ``sample`` vectors fit the centroids, at most ``most_cells`` of them."""
    cell: int = 250
    blocks_of: int = 128     # crowded cells are cut at twice ``cell``; at most so many pieces make a block
    numbers: int = 1 << 22   # components in a block, in the sample a multiple of four
    queries: int = 8_192     # of a block in one task
    sample: int = 20_000
    turns: int = 500         # sampled vectors whose links tell how far a link crosses borders
    most_cells: int = 4096
    overlap: int = 2         # cells that a vector is a member of
    rivals: int = 4          # cells nearest to a query whose borders bound what other cells can hold
    beam: int = 8            # to begin with; the audit makes it longer
    starts: int = 3          # medoids, the nearest to the query, that a search starts from
    audited: int = 48        # so many queries of a block are compared with all its vectors
    wanted: float = 0.98     # share of the audited links that must be found


def usable(embedding: Column) -> Column:
    """Not null, not empty, all components finite, and not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def distinct_vectors(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, rep) of comparable vectors, and (rep, label, size, vector, copies, least) once per vector.

    Equal vectors are folded before the shuffle, so a vector that a third of all rows hold moves once a task.
    """
    rows = embeddings.select("vec_id", F.col("label").cast("string").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("label").isNotNull() & usable(F.col("vector")))
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))  # -0.0 becomes 0.0
    rows = rows.withColumn("rep", F.xxhash64("label", "vector"))
    reps = rows.groupBy("rep", "label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    return rows.select("vec_id", "rep"), reps.select("rep", "label", F.size("vector").alias("size"), "vector", "copies", "least")


def _unit(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    rows = rows / np.where(largest > 0, largest, 1)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def _matrix(column) -> np.ndarray:
    """Vectors of one length as a matrix of unit rows."""
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return _unit(flat.to_numpy(zero_copy_only=False).reshape(len(column), -1))


def fit_cells(reps: DataFrame, plan: Plan) -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
    """For crowded (label, size) groups the cell centroids and the number of the group of each cell."""
    crowded = reps.groupBy("label", "size").count().where(F.col("count") > plan.cell) \
        .orderBy(F.desc("count"), "label", "size").limit(plan.most_cells).collect()
    if not crowded:
        return {}
    total = sum(r["count"] for r in crowded)
    sample: dict[tuple[str, int], list] = {}
    rows = min(plan.sample, max(1, 4 * plan.numbers // max(r["size"] for r in crowded)))
    for r in reps.orderBy("rep").limit(rows).select("label", "size", "vector").collect():
        sample.setdefault((r["label"], r["size"]), []).append(r["vector"])
    cells = {}
    for r in crowded:
        key, most = (r["label"], r["size"]), max(1, int(plan.most_cells * r["count"] / total))
        if key in sample:
            x = _unit(np.array(sample[key], np.float64))
            centroids = _means(x, min(math.ceil(r["count"] / plan.cell), most, max(1, len(x) // 4)))
            heads = _means(centroids, math.ceil(len(centroids) / plan.blocks_of))
            cells[key] = (centroids, np.argmax(centroids @ heads.T, 1), crossing(x, centroids, plan))
    return cells


def crossing(x: np.ndarray, centroids: np.ndarray, plan: Plan) -> float:
    """How far links cross the borders between cells, at most sin(acos(RANGE)), with a quarter to spare.

    For a query and a vector in its range it is the query's way beyond the border between the vector's cell and
    the nearest of the query's own. Seen on all sampled links of ``turns`` vectors, and on vectors turned to the
    end of the range: at random and towards another vector of the sample.
    """
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    home, k, most = np.argmax(x @ centroids.T, 1), min(plan.rivals, len(centroids)), 0.0
    some = np.unique(np.linspace(0, len(x) - 1, min(plan.turns, len(x))).astype(int))

    def passed(query, found):
        near = centroids @ query
        rival = np.argpartition(-near, k - 1)[:k]
        cell = np.unique(home[found])
        way, width = near[rival][:, None] - near[cell][None], apart[np.ix_(rival, cell)]
        return float(np.where(width > 1e-6, way / np.maximum(width, 1e-6), 0).max(initial=0))

    towards = x[np.random.default_rng(len(x)).permutation(len(x))[:len(some)]]
    for q in (turned(x[some], len(x)), turned(x[some], 0, towards)):
        most = max(most, *(passed(row, [i]) for row, i in zip(q, some.tolist())))
    for i in some.tolist():
        most = max(most, passed(x[i], np.flatnonzero(x @ x[i] >= RANGE)))
    return min(1.25 * most, math.sin(math.acos(RANGE)))


def _means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; empty clusters keep their place."""
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds if k > 1 else 1):
        own = np.argmax(x @ centre.T, 1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, x)
        some = np.linalg.norm(sums, axis=1) > 1e-9
        centre[some] = _unit(sums[some])
    return centre


def assigned(reps: DataFrame, cells, plan: Plan) -> DataFrame:
    """reps with ``own`` (cells and their groups of which it is a member, the nearest first) and ``angle`` (to the
    centroid of the first)."""
    shipped = reps.sparkSession.sparkContext.broadcast(cells)

    def run(batches):
        cells = shipped.value
        for batch in slices(batches, 4096):
            keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
            own, angle = [[(0, 0)]] * len(keys), np.zeros(len(keys))
            for key in set(keys) & set(cells):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                centroids, group, _ = cells[key]
                near = _matrix(batch.column("vector").take(pa.array(at))) @ centroids.T
                order = np.argsort(-near, axis=1, kind="stable")[:, :plan.overlap]
                angle[at] = np.arccos(np.clip(near.max(1), -1, 1))
                for i, best in zip(at.tolist(), order):
                    own[i] = [(int(c), int(group[c])) for c in best]
            kind = pa.list_(pa.struct([("cell", pa.int32()), ("grp", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([[{"cell": c, "grp": g} for c, g in o] for o in own], kind), pa.array(angle)],
                [*batch.schema.names, "own", "angle"])

    return reps.mapInArrow(run, "rep bigint, label string, size int, vector array<double>, copies bigint, "
                                "own array<struct<cell: int, grp: int>>, angle double")


def cell_bounds(members: DataFrame, cells) -> dict[tuple[str, int], np.ndarray]:
    """For every cell of ``cells`` the least and the largest angle between its centroid and the vectors to which it
    is the nearest; without such vectors infinity and its negative. At most one row per cell reaches the driver."""
    out = {key: np.tile([np.inf, -np.inf], (len(c[0]), 1)) for key, c in cells.items()}
    for r in members.groupBy("label", "size", F.col("own")[0]["cell"].alias("cell")) \
            .agg(F.min("angle").alias("least"), F.max("angle").alias("most")).collect() if cells else []:
        if (r["label"], r["size"]) in out:
            out[r["label"], r["size"]][r["cell"]] = r["least"], r["most"]
    return out


def reachable(x: np.ndarray, centroids: np.ndarray, bounds: np.ndarray, rivals: int, beyond: float) -> np.ndarray:
    """For every row of ``x`` (unit length) the cells that can hold a vector in range as its nearest cell.

    A cell is left out where the query's angle to the centroid differs by more than the range from those of all
    the cell's vectors, or where the border between the cell and one of the ``rivals`` centroids nearest to the
    query is farther than ``beyond``. The first is exact up to rounding, for which there is room; so is the second
    at sin(acos(RANGE)), while a smaller ``beyond`` is what ``crossing`` has seen.
    """
    room, theta = 1e-6, math.acos(RANGE)
    near = x @ centroids.T
    some = np.isfinite(bounds[:, 0])
    low = np.cos(np.minimum(np.where(some, bounds[:, 1], 0) + theta + room, math.pi)) - room
    high = np.cos(np.maximum(np.where(some, bounds[:, 0], 0) - theta - room, 0)) + room
    out = some & (near >= low) & (near <= high)
    k = min(rivals, len(centroids))
    apart = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    for rival in np.argpartition(-near, k - 1, axis=1)[:, :k].T:
        out &= near[np.arange(len(x)), rival][:, None] - near <= beyond * apart[rival] + room
    return out


def probing(members: DataFrame, cells, plan: Plan, places=None) -> DataFrame:
    """rep, label, size, vector, ``probes``: the groups that hold its ``reachable`` cells, and ``places``: their blocks,
    null for vectors without cells. ``places`` has for every cell its first and its last place."""
    shipped = members.sparkSession.sparkContext.broadcast((cells, cell_bounds(members, cells), places or {}))

    def run(batches):
        cells, bounds, places = shipped.value
        for batch in slices(batches, 1024):
            keys = list(zip(batch.column("label").to_pylist(), batch.column("size").to_pylist()))
            probes, visits = [[0]] * len(keys), [None] * len(keys)
            for key in set(keys) & set(cells):
                at = np.array([i for i, k in enumerate(keys) if k == key])
                centroids, group, beyond = cells[key]
                reach = reachable(_matrix(batch.column("vector").take(pa.array(at))), centroids, bounds[key], plan.rivals, beyond)
                for i, row in zip(at.tolist(), reach):
                    probes[i] = np.unique(group[row]).tolist()
                    if key in places:
                        visits[i] = sorted({p for f, e in places[key][row].tolist() for p in range(f, e + 1)})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(probes, pa.list_(pa.int32())), pa.array(visits, pa.list_(pa.int64()))],
                                             [*batch.schema.names, "probes", "places"])

    return members.select("rep", "label", "size", "vector").mapInArrow(
        run, "rep bigint, label string, size int, vector array<double>, probes array<int>, places array<bigint>")


def placed_cells(layout: DataFrame, cells) -> dict[tuple[str, int], np.ndarray]:
    """For every cell of ``cells`` its first and last place (group and block); one row per cell reaches the driver."""
    out = {key: np.tile([0, -1], (len(c[0]), 1)) for key, c in cells.items()}
    for r in layout.where(F.col("crowded")).collect() if cells else []:
        first, last = r["before"] // r["many"], (r["before"] + r["pieces"] - 1) // r["many"]
        out[r["label"], r["size"]][r["cell"]] = (r["grp"] << 32) + first, (r["grp"] << 32) + last
    return out


def robust_prune(distance: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For every row the candidates that stay, -1 behind them; candidates lie in order of distance.

    The nearest one left is kept, and all that are ``alpha`` times nearer to it than to the row are let go.
    """
    n, width = candidates.shape
    rows = np.arange(n)
    real = candidates >= 0
    reach = np.where(real, distance[rows[:, None], candidates], np.inf)
    alive = real & (candidates != rows[:, None])
    out = np.full((n, degree), -1, np.int32)
    for k in range(degree):
        first = alive.argmax(1)
        some = alive[rows, first]
        if not some.any():
            break
        chosen = candidates[rows, first]
        out[some, k] = chosen[some]
        alive &= alpha * distance[chosen[:, None], candidates] > reach
        alive[rows, first] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> tuple[list[np.ndarray], int]:
    """Neighbour lists over the rows of ``x`` (unit length) and the medoid, from which all can be reached."""
    n = len(x)
    near = x.astype(np.float32) @ x.astype(np.float32).T
    medoid = int(np.argmax(near.sum(1)))
    if n <= degree:
        return [np.delete(np.arange(n), i) for i in range(n)], medoid
    distance = np.sqrt(np.maximum(2 - 2 * near, 0))
    np.fill_diagonal(distance, 0)
    close = np.argpartition(distance, min(4 * degree, n - 1), axis=1)[:, :4 * degree + 1]
    far = np.random.default_rng(n).integers(0, n, (n, degree))
    picked = _sorted(distance, np.concatenate([close, far], 1))
    forward = robust_prune(distance, picked, degree, alpha)
    # Both directions, pruned again.
    a, k = np.nonzero(forward >= 0)
    b = forward[a, k]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.lexsort((distance[a, b], a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a)
    keep = place < 6 * degree
    both = np.full((n, 6 * degree), -1, np.int64)
    both[a[keep], place[keep]] = b[keep]
    final = robust_prune(distance, _sorted(distance, both), 2 * degree, alpha)
    lists = [set(row[row >= 0].tolist()) for row in final]
    # What can't be reached from the medoid is joined to the nearest vector that can.
    reached = np.zeros(n, bool)
    frontier = [medoid]
    while True:
        while frontier:
            reached[frontier] = True
            frontier = [v for v in set().union(*(lists[u] for u in frontier)) if not reached[v]]
        rest = np.flatnonzero(~reached)
        if not len(rest):
            return [np.fromiter(s, np.int64, len(s)) for s in lists], medoid
        inside = np.flatnonzero(reached)
        between = near[np.ix_(rest, inside)]
        u, v = np.unravel_index(int(between.argmax()), between.shape)
        lists[inside[v]].add(int(rest[u]))
        lists[rest[u]].add(int(inside[v]))
        frontier = [int(rest[u])]


def _sorted(distance: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Every row's candidates in order of distance, repeated ones as -1."""
    rows = np.arange(len(candidates))[:, None]
    reach = np.where(candidates >= 0, distance[rows, candidates], np.inf)
    order = np.lexsort((candidates, reach), axis=1)
    out = np.take_along_axis(candidates, order, 1)
    out[:, 1:][out[:, 1:] == out[:, :-1]] = -1
    return out


class Searcher:
    """Range search on one block, many queries side by side: ``x`` unit rows, ``lists`` united neighbour lists,
    ``starts`` the medoids of the pieces and ``cells`` their cells. What no medoid leads to gets starts of its own,
    which every query takes. ``compared`` counts the cosines."""

    def __init__(self, x: np.ndarray, lists: list[np.ndarray], starts: np.ndarray, cells: np.ndarray, beam: int):
        self.x, self.low, self.beam, self.compared = x, x.astype(np.float32), beam, 0
        self.size = np.array([len(s) for s in lists], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.concatenate([*lists, np.zeros(0, np.int64)]).astype(np.int64)
        self.medoids = len(starts)
        reached = np.zeros(len(x), bool)
        self._reach(np.asarray(starts, np.int64), reached)
        alone = []
        for v in np.flatnonzero(~reached).tolist():
            if not reached[v]:
                alone.append(v)
                self._reach(np.array([v]), reached)
        self.starts = np.concatenate([starts, alone]).astype(np.int64)
        self.cell = np.unique(np.concatenate([cells, np.full(len(alone), -1)]), return_inverse=True)[1]
        self.at_once = int(max(1, min(256, MARKS // max(1, len(x)))))
        self.seen = np.zeros(self.at_once * len(x), bool)
        self.writer = np.zeros(self.at_once * len(x), np.int32)

    def _targets(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of all ``nodes`` in a row, and how many each has."""
        size = self.size[nodes]
        ends = np.cumsum(size)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[nodes] - ends + size, size)], size

    def _reach(self, frontier: np.ndarray, reached: np.ndarray) -> None:
        reached[frontier] = True
        while len(frontier):
            found = self._targets(frontier)[0]
            frontier = np.unique(found[~reached[found]])
            reached[frontier] = True

    def _fresh(self, keys: np.ndarray) -> np.ndarray:
        """Places of those ``keys`` (query and node) that were not seen yet, each once; they are marked."""
        at = np.flatnonzero(~self.seen[keys])
        self.writer[keys[at]] = at
        at = at[self.writer[keys[at]] == at]
        self.seen[keys[at]] = True
        return at

    def _near(self, low: np.ndarray, which: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        self.compared += len(nodes)
        return np.einsum("ij,ij->i", self.low[nodes], low[which])

    def within(self, queries: np.ndarray, margin: float, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) whose cosine is RANGE or more, as far as the search finds them, in order of queries."""
        parts = [self._within(queries[i:i + self.at_once], margin, most, i) for i in range(0, len(queries), self.at_once)]
        return (np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]),
                np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)]))

    def _within(self, queries: np.ndarray, margin: float, most: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        low, n = queries.astype(np.float32), len(self.x)
        # Where to start: every piece of the cells whose medoids are nearest.
        near = low @ self.low[self.starts].T
        self.compared += near.size
        chosen = np.ones(near.shape, bool)
        if self.medoids > most:
            picked = np.zeros((len(low), self.cell.max() + 1), bool)
            best = np.argpartition(-near[:, :self.medoids], most - 1, axis=1)[:, :most]
            np.put_along_axis(picked, self.cell[best], True, 1)
            chosen[:, :self.medoids] = picked[:, self.cell[:self.medoids]]
        query, start = np.nonzero(chosen)
        keys = query * n + self.starts[start]
        at = np.sort(self._fresh(keys))
        query, keys, gain = query[at], keys[at], near[query[at], start[at]]
        met, gains = [keys], [gain]
        # Greedy from each medoid with a beam of its own: the nearest that were not expanded yet, until nothing
        # nearer turns up. One beam for all would fill with one cell's vectors and never enter the others.
        lane, todo, worst = np.arange(len(keys)), np.ones(len(keys), bool), np.full(len(keys), -2, np.float32)
        while True:
            at = np.flatnonzero(todo)
            at = at[np.arange(len(at)) - np.searchsorted(lane[at], lane[at]) < STEP]
            if not len(at):
                break
            todo[at] = False
            found, size = self._targets(keys[at] - query[lane[at]] * n)
            own = np.repeat(lane[at], size)
            fresh = self._fresh(query[own] * n + found)
            own, found = own[fresh], found[fresh]
            value = self._near(low, query[own], found)
            found += query[own] * n
            met.append(found)
            gains.append(value)
            better = value > worst[own]
            found, own, value = found[better], own[better], value[better]
            if not len(found):
                continue
            keys, lane, gain = np.concatenate([keys, found]), np.concatenate([lane, own]), np.concatenate([gain, value])
            todo = np.concatenate([todo, np.ones(len(found), bool)])
            order = np.lexsort((-gain, lane))
            place = np.arange(len(order)) - np.searchsorted(lane[order], lane[order])
            order, place = order[place < self.beam], place[place < self.beam]
            keys, lane, gain, todo = keys[order], lane[order], gain[order], todo[order]
            worst[lane[place == self.beam - 1]] = gain[place == self.beam - 1]
        # Range: everything in range or a margin around it is expanded as well. A query with so much of it that
        # its lists cost more than the block is compared with the whole block; its links are as many.
        keys, gain = np.concatenate(met), np.concatenate(gains)
        met, gains = [keys], [gain]
        waiting = keys[gain >= RANGE - margin]
        expanded, crowded = np.zeros(len(low), np.int64), np.zeros(len(low), bool)
        while len(waiting):
            now, waiting = waiting[:2048], waiting[2048:]
            now = now[~crowded[now // n]]
            expanded += np.bincount(now // n, minlength=len(low))
            crowded |= expanded > max(64, n // 8)
            found, size = self._targets(now % n)
            found = np.repeat(now - now % n, size) + found
            found = found[self._fresh(found)]
            value = self._near(low, found // n, found % n)
            met.append(found)
            gains.append(value)
            waiting = np.concatenate([waiting, found[value >= RANGE - margin]])
        keys, gain = np.concatenate(met), np.concatenate(gains)
        self.seen[keys] = False
        keys = keys[(gain >= RANGE - 1e-4) & ~crowded[keys // n]]
        for i in np.flatnonzero(crowded).tolist():
            self.compared += n
            keys = np.concatenate([keys, i * n + np.flatnonzero(self.low @ low[i] >= RANGE - 1e-4)])
        keys = np.sort(keys)
        keep = [np.einsum("ij,ij->i", self.x[part % n], queries[part // n]) >= RANGE
                for part in np.split(keys, range(65536, len(keys), 65536))]
        keys = keys[np.concatenate(keep)]
        return keys // n + first, keys % n


def turned(x: np.ndarray, seed: int, towards: np.ndarray | None = None) -> np.ndarray:
    """Every row of ``x`` (unit length) turned to cosines from RANGE to 0.97, ``towards`` given rows or at random."""
    aside = np.random.default_rng(seed).normal(size=x.shape) if towards is None else towards
    aside = aside - np.einsum("ij,ij->i", aside, x)[:, None] * x
    cosine = np.linspace(RANGE + 1e-9, 0.97, len(x))[:, None]
    return cosine * x + np.sqrt(1 - cosine ** 2) * _unit(aside) if x.shape[1] > 1 else x


def search_block(nodes, queries, plan: Plan, told: list | None = None):
    """Counts (query, links) and forest links of a block, all found by the graph.

    ``nodes`` and ``queries`` are tuples of arrays. ``home`` is true for the nodes whose nearest cell lies in
    this block, and only they count: all in a query's range do so in one of the blocks that it visits.

    The audit has a fixed size: ``audited`` queries are compared with all vectors, and as many vectors of the block
    are turned, with links to what they come from, which measures the search where links are rare. While
    it finds less than ``wanted`` of either, it takes more medoids, then a longer beam and a wider margin.
    ``told`` receives (cosines, links of the audit, links of it that were found).
    """
    x, rep, copies, lists, starts, cells, home = nodes
    q, q_rep = queries
    some = np.unique(np.linspace(0, len(q) - 1, min(plan.audited, len(q))).astype(int))
    near = q[some] @ x.T >= RANGE
    near &= rep[None] != q_rep[some][:, None]
    plants = np.unique(np.linspace(0, len(x) - 1, min(4 * plan.audited, len(x))).astype(int))
    planted = turned(x[plants], len(x))
    searcher = Searcher(x, lists, starts, cells, plan.beam)
    margin, most = 0.08, plan.starts

    def hits(which, ids):
        a, b = searcher.within(which, margin, most)
        if ids is not None:
            other = rep[b] != ids[a]
            a, b = a[other], b[other]
        return a, b

    while True:
        a, b = hits(q[some], q_rep[some])
        real = near[a, b].sum()
        a, b = hits(planted, None)
        made = (plants[a] == b).sum()
        if (real >= plan.wanted * near.sum() and made >= plan.wanted * len(plants)) or margin >= 2:
            break
        if most < len(starts) and most < 8 * plan.starts:
            most *= 2
        elif searcher.beam < 16 * plan.beam:
            searcher.beam *= 2
        elif most < len(starts):
            most *= 2
        else:
            margin *= 2
    every = np.unique(np.concatenate([rep, q_rep]))
    node_at, query_at = np.searchsorted(every, rep), np.searchsorted(every, q_rep)
    linked = np.zeros(len(q), np.int64)
    forest_a = forest_b = np.zeros(0, np.int64)
    for i in range(0, len(q), searcher.at_once):
        a, b = hits(q[i:i + searcher.at_once], q_rep[i:i + searcher.at_once])
        np.add.at(linked, a + i, np.where(home[b], copies[b], 0))
        forest_a, forest_b = _forest(len(every), [query_at[a + i], forest_a], [node_at[b], forest_b]) if len(a) else (forest_a, forest_b)
    if told is not None:
        told.append((searcher.compared, int(near.sum()) + len(plants), int(real + made)))
    return linked, every[forest_a], every[forest_b]


def _forest(n: int, a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    root = local_roots(n, np.concatenate(a), np.concatenate(b))
    other = np.flatnonzero(root != np.arange(n))
    return other, root[other]


def _build_cell(table: pa.Table) -> pa.Table:
    rep = table.column("rep").to_numpy()
    lists, medoid = build_graph(_matrix(table.column("vector")))
    return pa.table({
        "label": table.column("label"), "size": table.column("size"), "grp": table.column("grp"), "block": table.column("block"),
        "rep": pa.array(rep), "near": pa.array([rep[s] for s in lists], pa.list_(pa.int64())),
        "start": pa.array([table.column("cell")[0].as_py() if i == medoid else None for i in range(len(rep))], pa.int32())})


def _search(table: pa.Table, plan: Plan) -> pa.Table:
    kind = table.column("kind").to_numpy()
    node, query = table.filter(pa.array(kind == 0)), table.filter(pa.array(kind == 1))
    adjacency = table.filter(pa.array(kind == 2))
    empty = {"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())}
    if not node.num_rows or not query.num_rows:
        return pa.table(empty)
    rep = node.column("rep").to_numpy()
    order = np.argsort(rep)
    node, rep = node.take(pa.array(order)), rep[order]
    medoids = adjacency.column("start").combine_chunks()
    starts = np.repeat(adjacency.column("rep").to_numpy(), medoids.value_lengths().to_numpy(zero_copy_only=False))
    size = adjacency.column("near").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    flat = adjacency.column("near").combine_chunks().flatten().to_numpy()
    at = np.searchsorted(rep, flat)
    known = (at < len(rep)) & (rep[np.minimum(at, len(rep) - 1)] == flat)
    lists: list[np.ndarray] = [np.zeros(0, np.int64)] * len(rep)
    for r, e, n in zip(np.searchsorted(rep, adjacency.column("rep").to_numpy()).tolist(), ends.tolist(), size.tolist()):
        lists[r] = at[e - n:e][known[e - n:e]]
    q_rep = query.column("rep").to_numpy()
    linked, a, b = search_block(
        (_matrix(node.column("vector")), rep, node.column("copies").to_numpy(), lists, np.searchsorted(rep, starts),
         medoids.flatten().to_numpy(), node.column("home").to_numpy(zero_copy_only=False).astype(bool)),
        (_matrix(query.column("vector")), q_rep), plan)
    some = np.flatnonzero(linked)
    return pa.table({
        "rep": pa.array(np.concatenate([q_rep[some], a])),
        "links": pa.array(np.concatenate([linked[some], np.zeros(len(a), np.int64)])),
        "other": pa.array(np.concatenate([np.zeros(len(some), np.int64), b]), mask=np.arange(len(some) + len(a)) < len(some))})


def links(reps: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """Rows (rep, links, null): vectors linked to rep found in a block, copies included, to be summed; and rows
    (rep, 0, other): links that span the components."""
    cells = fit_cells(reps, plan)
    members = cut_lineage(assigned(reps.select("rep", "label", "size", "vector", "copies"), cells, plan), "cells")
    # Where each cell lies: its pieces, numbered through its group. One small row per cell.
    count = members.select("label", "size", F.explode("own").alias("o")).groupBy("label", "size", "o.grp", "o.cell").count()
    count = count.withColumn("pieces", F.ceil(F.col("count") / (2 * plan.cell)).cast("int"))
    many = F.least(F.lit(plan.blocks_of), F.greatest(F.lit(1), F.lit(plan.numbers) / (2 * plan.cell * F.col("size")))).cast("int")
    spark = reps.sparkSession
    known = spark.createDataFrame([(*key, True) for key in cells], "label string, size int, crowded boolean")
    before = W.partitionBy("label", "size", "grp").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    layout = cut_lineage(count.join(known, ["label", "size"], "left").select(
        "label", "size", "grp", "cell", "pieces", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("before"),
        many.alias("many"), F.coalesce("crowded", F.lit(False)).alias("crowded")), "layout")
    keys = ["label", "size", "grp"]

    piece = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("pieces")).cast("int")
    placed = members.select("*", F.posexplode("own").alias("at", "o")).select(
        "rep", "label", "size", "vector", "copies", (F.col("at") == 0).alias("home"), F.col("o.grp").alias("grp"), F.col("o.cell").alias("cell")) \
        .join(layout, [*keys, "cell"]).withColumn("piece", piece) \
        .withColumn("block", F.floor((F.col("before") + F.col("piece")) / F.col("many")).cast("int"))
    placed = cut_lineage(placed.select("rep", *keys, "cell", "piece", "block", "vector", "copies", "home"), "placed")
    graph = placed.select("rep", *keys, "cell", "piece", "block", "vector").groupBy(*keys, "cell", "piece", "block").applyInArrow(
        _build_cell,
        "label string, size int, grp int, block int, rep bigint, near array<bigint>, start int")
    # The union of a vector's lists; at most its cells times the degree.
    united = graph.groupBy(*keys, "block", "rep").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.collect_list("start").alias("start"))
    nodes = placed.groupBy(*keys, "block", "rep").agg(
        F.first("vector").alias("vector"), F.first("copies").alias("copies"), F.max("home").alias("home"))

    none = lambda kind: F.lit(None).cast(kind)
    as_node = nodes.select(*keys, "block", "rep", F.lit(0).alias("kind"), "vector", "copies", "home",
                           none("array<bigint>").alias("near"), none("array<int>").alias("start"))
    as_list = united.select(*keys, "block", "rep", F.lit(2).alias("kind"), none("array<double>").alias("vector"),
                            F.lit(0).cast("bigint").alias("copies"), F.lit(False).alias("home"), "near", "start")
    # Who visits which block; a vector without cells visits all blocks of its label, hardly ever more than one.
    probed = cut_lineage(probing(members, cells, plan, placed_cells(layout, cells)).drop("probes"), "probed")
    blocks = layout.where(~F.col("crowded")).groupBy("label", "size").agg(
        F.max(F.floor((F.col("before") + F.col("pieces") - 1) / F.col("many"))).alias("last"))
    wide = probed.where("places IS NULL").drop("places").join(blocks, ["label", "size"]).select(
        "rep", "label", "size", "vector", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("last"))).alias("place"))
    visits = probed.select("rep", "label", "size", "vector", F.explode("places").alias("place")).unionByName(wide).select(
        "rep", "label", "size", F.shiftright("place", 32).cast("int").alias("grp"),
        F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("block"), "vector")
    # A block's vectors are copied once for so many queries of it, and no oftener.
    at = [*keys, "block"]
    shares = cut_lineage(visits.groupBy(*at).agg(F.ceil(F.count("*") / plan.queries).cast("int").alias("shares")), "shares")
    stored = as_node.unionAll(as_list).join(shares, at).select(
        *at, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), "rep", "kind", "vector", "copies",
        "home", "near", "start")
    asked = visits.join(shares, at).select(
        *at, F.pmod(F.xxhash64("rep", F.lit(2)), F.col("shares")).cast("int").alias("share"), "rep", F.lit(1).alias("kind"), "vector",
        F.lit(0).cast("bigint").alias("copies"), F.lit(False).alias("home"), none("array<bigint>").alias("near"),
        none("array<int>").alias("start"))
    return stored.unionByName(asked).groupBy(*keys, "block", "share").applyInArrow(
        lambda table: _search(table, plan), "rep bigint, links bigint, other bigint")


def embedding_groups(embeddings: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    * Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label,
      link with nothing: no links, a component of their own, kept. Vectors of different length never link.
    * Copies are linked with each other and count each; rows that repeat a vec_id count as vectors of their
      own, and component_id is the smallest vec_id of the component. A null vec_id is never the smallest, stays
      null if its component has no id, and is kept then.
    * Extra columns are not read; an empty table gives an empty result.
    """
    rows, reps = distinct_vectors(embeddings)
    reps = cut_lineage(reps, "vectors")
    found = cut_lineage(links(reps, plan), "found")
    member = connected_components(found.where("other IS NOT NULL").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    counted = found.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
    each = reps.select("rep", "copies", "least").join(member.withColumnRenamed("node", "rep"), "rep", "left").join(counted, "rep", "left")
    each = cut_lineage(each.select("rep", "copies", "least", F.coalesce("root", "rep").alias("root"),
                                   F.coalesce("links", F.lit(0)).alias("links")), "members")
    result = each.join(each.groupBy("root").agg(F.min("least").alias("component")), "root").select(
        "rep", (F.col("links") + F.col("copies") - 1).alias("links"), "component")
    ids = embeddings.select("vec_id", F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    clean = F.transform("vector", lambda x: x + F.lit(0.0))
    key = F.when(F.col("label").isNotNull() & usable(F.col("vector")), F.xxhash64("label", clean))
    return ids.select("vec_id", key.alias("rep")).join(result, "rep", "left").select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id")) \
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit_recall(embeddings: DataFrame, plan: Plan = Plan(), divisor: int = 50) -> DataFrame:
    """One row (expected, found): links of the queries, all rows whose vec_id is divisible by ``divisor``, by
    comparing them with all vectors in blocks, and by the index."""
    _, reps = distinct_vectors(embeddings)
    queries = embeddings.where(F.col("vec_id") % divisor == 0)
    asked = distinct_vectors(queries)[1].select("rep", "label", "size", "vector")
    blocks = 32
    left = asked.withColumn("share", F.pmod(F.xxhash64("rep"), F.lit(4)).cast("int")).select(
        "label", "size", "share", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "rep", "vector",
        F.lit(0).cast("bigint").alias("copies"))
    right = reps.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks)).cast("int")).select(
        "label", "size", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("share"), "block", "rep", "vector", "copies")

    def compare(table: pa.Table) -> pa.Table:
        asks = table.filter(pa.array(table.column("copies").to_numpy() == 0))
        has = table.filter(pa.array(table.column("copies").to_numpy() > 0))
        if not asks.num_rows or not has.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
        near = _matrix(asks.column("vector")) @ _matrix(has.column("vector")).T >= RANGE
        near &= asks.column("rep").to_numpy()[:, None] != has.column("rep").to_numpy()[None]
        return pa.table({"rep": asks.column("rep"), "links": pa.array(near @ has.column("copies").to_numpy())})

    exact = left.unionByName(right).groupBy("label", "size", "share", "block").applyInArrow(compare, "rep bigint, links bigint")
    exact = exact.groupBy("rep").agg(F.sum("links").alias("expected"))
    found = links(cut_lineage(reps, "vectors"), plan).where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("found"))
    return exact.join(found, "rep", "left").agg(F.sum("expected").alias("expected"), F.coalesce(F.sum("found"), F.lit(0)).alias("found"))
