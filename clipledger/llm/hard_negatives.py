"""Hard negatives by exact maximum inner product search in cover trees.

Candidates get one component more, the root of M * M less their squared norm, so that all lie on a sphere of radius M, the
largest norm; queries get a zero there. Inner products stay as they were, and between a query at angle t from a node's centre
and candidates within angle r of it they lie from |q| M cos(t + r) to |q| M cos(t - r). Pivots from a bounded sample deal all
candidates into cells with exact radii; cells are cut into blocks of bounded size, and each block is a cover tree, down to where
its nodes would hold too few rows to be worth a bound. Queries open cells, then nodes, whose bounds reach what they look for,
best first, and all queries of a leaf meet its rows in one matrix product of whole numbers. What a query looks for begins
where the sample already has as many such rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipledger.llm.support import stage

#: Rows the pivots are chosen from, and how many pivots there are at most.
SAMPLE_ROWS = 4096
PIVOTS = 64
#: Candidates of a block, about, and queries that meet a block in one task.
BLOCK_ROWS = 16384
QUERIES_TOGETHER = 8192
#: Ratio of covering radii from one level of a tree to the next, and rows of a leaf.
RATIO = 1.5
LEAF_ROWS = 96
#: Rows that children hold on average, at least: a bound costs more than an inner product, so nodes that fall into smaller ones are leaves.
CHILD_ROWS = 32
#: Inner products that are made at a time.
PRODUCTS = 1 << 18
#: Added to angles, against rounding.
SLACK = 1e-6
SCALE = 256
#: Whole numbers below this are exact, the shorter type first.
EXACT = {np.float32: 0.99 * (1 << 24), np.float64: 0.99 * (1 << 53)}

_ROW = "vec_id long, label long, vector binary, norm double"
#: Queries that are routed at a time.
ROUTED = 256


# -- vectors as bytes: 64-bit whole numbers, without zeros at the end ---------------------------------
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("vector")
        flat = vectors.values.to_numpy(zero_copy_only=False)
        ends = vectors.offsets.to_numpy()
        rows = [np.trim_zeros(flat[a:b], "b").astype("<i8") for a, b in zip(ends, ends[1:])]
        norms = [math.sqrt(float(np.square(row.astype(np.float64)).sum())) for row in rows]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("vec_id"),
                batch.column("label"),
                pa.array([row.tobytes() for row in rows], pa.binary()),
                pa.array(norms, pa.float64()),
                batch.column("anchor"),
            ],
            names=["vec_id", "label", "vector", "norm", "anchor"],
        )


def matrix(vectors: list[bytes], width: int = 0) -> np.ndarray:
    """Rows of whole numbers as doubles where all inner products of such rows are exact so, else as Python integers."""
    sizes = {len(vector) // 8 for vector in vectors}
    width = max([width, *sizes])
    if sizes == {width}:
        out = np.frombuffer(b"".join(vectors), "<i8").reshape(len(vectors), width)
    else:
        out = np.zeros((len(vectors), width), np.int64)
        for row, vector in zip(out, vectors):
            row[: len(vector) // 8] = np.frombuffer(vector, "<i8")
    doubles = out.astype(np.float64)
    largest = float(np.abs(doubles).max(initial=0))
    return doubles if largest * largest * max(width, 1) < EXACT[np.float64] else out.astype(object)


def longest(rows: np.ndarray) -> float:
    """The greatest norm."""
    return math.sqrt(float(np.square(rows.astype(np.float64)).sum(axis=1).max(initial=0)))


def exact_type(of_rows: float, of_queries: float) -> type | None:
    """A float type that holds all inner products without rounding, given the greatest norms: whatever part of a product's terms
    is summed first, the sum is a whole number no greater than the product of the norms. None if there is no such type."""
    return next((kind for kind, limit in EXACT.items() if of_rows * of_queries < limit), None)


def products(rows: np.ndarray, queries: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products (queries, rows). ``exact``: whole numbers of the arrays' type, which holds them without rounding; else 64-bit
    integers, beyond these the nearest one."""
    width = min(rows.shape[1], queries.shape[1])
    if exact:
        return queries[:, :width] @ rows[:, :width].T
    low, high = -(1 << 63), (1 << 63) - 1
    whole = [
        [min(max(sum(int(a) * int(b) for a, b in zip(query[:width], row[:width])), low), high) for row in rows] for query in queries
    ]
    return np.array(whole, np.int64).reshape(len(queries), len(rows))


class Sphere:
    """Unit directions of candidates after they got their last component, and angles between them."""

    def __init__(self, largest: float, width: int):
        self.largest, self.width = max(largest, 1e-300), width

    def _wide(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), self.width + 1))
        out[:, : rows.shape[1]] = rows.astype(np.float64) / self.largest
        return out

    def candidates(self, rows: np.ndarray) -> np.ndarray:
        out = self._wide(rows)
        out[:, -1] = np.sqrt(np.maximum(1 - np.square(out).sum(axis=1), 0))
        return out

    def queries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Directions, and by how much a cosine is multiplied to give an inner product."""
        out = self._wide(rows)
        norms = np.sqrt(np.square(out).sum(axis=1))
        return out / np.maximum(norms, 1e-300)[:, None], norms * self.largest * self.largest


def angles(rows: np.ndarray, direction: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ direction, -1, 1))


def bounds(angle: np.ndarray, radius: np.ndarray, reach: float | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product with candidates within ``radius`` of a centre at ``angle``."""
    near, far = np.maximum(angle - radius - SLACK, 0), np.minimum(angle + radius + SLACK, math.pi)
    slack = reach * 1e-9 + 1e-6
    return reach * np.cos(far) - slack, reach * np.cos(near) + slack


# -- a cover tree, made from the top --------------------------------------------------------------------
def cover_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the points, and nodes (centre, first place, place after the last, first child, children, radius).

    A node's points lie within its radius of its centre. Its children's centres cover them within the level's radius, which shrinks by
    ``RATIO`` at least from a level to the next, and lie farther apart than that. Nodes of few points, of equal ones, or of points
    that would fall into children of fewer than ``CHILD_ROWS`` on average, are leaves.
    """
    order = np.arange(len(points))
    nodes: list[list[float]] = []
    if not len(points):
        return order, np.empty((0, 6))
    first = angles(points, points[0])
    nodes.append([0, 0, len(points), 0, 0, float(first.max())])
    waiting = [(0, first)]
    while waiting:
        at, far = waiting.pop()
        centre, since, to, _, _, radius = nodes[at]
        since, to = int(since), int(to)
        if to - since <= LEAF_ROWS or radius < 1e-7:
            continue
        level = radius / RATIO
        mine = order[since:to].copy()
        parts, rest, distance, lead = [], np.arange(len(mine)), far, int(centre)
        while len(rest):
            inside = distance <= level
            parts.append((lead, mine[rest[inside]], distance[inside]))
            rest = rest[~inside]
            if len(rest):
                if (len(parts) + 1) * CHILD_ROWS > len(mine):
                    break
                lead = int(mine[rest[0]])
                distance = angles(points[mine[rest]], points[lead])
                distance[0] = 0
        if len(rest):
            continue
        nodes[at][3:5] = [len(nodes), len(parts)]
        place = since
        for lead, members, distance in parts:
            order[place : place + len(members)] = members
            nodes.append([lead, place, place + len(members), 0, 0, float(distance.max(initial=0))])
            waiting.append((len(nodes) - 1, distance))
            place += len(members)
    return order, np.array(nodes, np.float64)


class Block:
    """Candidates of one block as a cover tree, in the tree's order.

    A whole batch of queries goes down the tree level by level: a node is opened by the queries whose bounds it can still serve.
    Each query is verified in the leaf with its greatest bound first; then leaf by leaf come the queries that it could still
    improve. Queries that meet a leaf are verified by matrix products, each query once for all its windows.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: list[bytes], nodes: np.ndarray, centres: list[bytes], sphere: Sphere):
        self.ids, self.labels, self.rows = ids, labels, matrix(vectors)
        self.since, self.to, self.child, self.children = (nodes[:, k].astype(int) for k in (1, 2, 3, 4))
        self.radius = nodes[:, 5]
        self.centres = sphere.candidates(matrix(centres))
        self.longest = longest(self.rows)

    def _leaves(
        self, directions: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First places of leaves and places after their last, and for each query its greatest possible score there; minus infinity
        where it need not look. Small leaves beside each other are one."""
        leaves, tops = [], []
        level, open_ = np.array([0]), np.ones((len(reach), 1), bool)
        while len(level):
            angle = np.arccos(np.clip(directions @ self.centres[level].T, -1, 1))
            least, greatest = bounds(angle, self.radius[level], reach[:, None])
            open_ &= (greatest >= low[:, None]) & (least <= high[:, None])
            ends = (self.children[level] == 0) & open_.any(axis=0)
            leaves += level[ends].tolist()
            tops.append(np.where(open_, greatest, -np.inf)[:, ends])
            inner = np.flatnonzero((self.children[level] > 0) & open_.any(axis=0))
            count = self.children[level[inner]]
            open_ = np.repeat(open_[:, inner], count, axis=1)
            level = _ranges(self.child[level[inner]], count)
        by = np.argsort(self.since[leaves], kind="stable") if leaves else np.empty(0, int)
        spans: list[list[int]] = []
        firsts = []
        for k, leaf in enumerate(np.array(leaves, int)[by].tolist()):
            since, to = int(self.since[leaf]), int(self.to[leaf])
            if spans and spans[-1][1] == since and to - spans[-1][0] <= LEAF_ROWS:
                spans[-1][1] = to
            else:
                spans.append([since, to])
                firsts.append(k)
        top = np.concatenate(tops, axis=1)[:, by]
        since, to = np.array(spans, int).reshape(-1, 2).T
        return since, to, np.maximum.reduceat(top, firsts, axis=1) if firsts else top

    def _meetings(self, since: int, to: int, some: np.ndarray, labels: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of rows, and queries that look there: label by label, if they look for their own."""
        places = np.arange(since, to)
        if not same:
            yield places, some
            return
        places = places[np.argsort(self.labels[since:to], kind="stable")]
        some = some[np.argsort(labels[some], kind="stable")]
        theirs, asked = self.labels[places], labels[some]
        for label in np.unique(asked):
            a, b = np.searchsorted(theirs, label), np.searchsorted(theirs, label, "right")
            if b > a:
                yield places[a:b], some[np.searchsorted(asked, label) : np.searchsorted(asked, label, "right")]

    def first(
        self,
        queries: np.ndarray,
        directions: np.ndarray,
        reach: np.ndarray,
        labels: np.ndarray,
        low: np.ndarray,
        high: np.ndarray,
        same: bool,
        count: int,
        owner: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores and vec_ids, (windows, count), of the first rows of a query's label (or of other ones, unless ``same``)
        with scores from ``low`` to ``high``; and which of them are there.

        Each query has a window, or those that ``owner`` gives it, one at least, in the order of queries.
        """
        owner = np.arange(len(queries)) if owner is None else owner
        since = np.searchsorted(owner, np.arange(len(queries)))
        windows = np.diff(np.append(since, len(owner)))
        scores, ids = (np.zeros((len(owner), count), np.int64) for _ in range(2))
        held = np.zeros((len(owner), count), bool)
        least = low.copy()
        floor, ceiling = np.minimum.reduceat(least, since), np.maximum.reduceat(high, since)
        kind = exact_type(self.longest, longest(queries))
        rows, asked = (self.rows, queries) if kind is None else (self.rows.astype(kind), queries.astype(kind))

        def keep(query: np.ndarray, place: np.ndarray, score: np.ndarray) -> None:
            at = np.repeat(np.arange(len(query)), windows[query])
            window = _ranges(since[query], windows[query])
            fits = (score[at] >= least[window]) & (score[at] <= high[window])
            window, at = window[fits], at[fits]
            changed = np.unique(window)
            old, nth = np.nonzero(held[changed])
            old = changed[old]
            window = np.concatenate([window, old])
            score = np.concatenate([score[at], scores[old, nth]])
            known = np.concatenate([self.ids[place[at]], ids[old, nth]])
            # Smaller scores come last, then greater ids.
            order = np.lexsort((known, ~score, window))
            window = window[order]
            rank = np.arange(len(window)) - np.searchsorted(window, window)
            best = rank < count
            window, rank, order = window[best], rank[best], order[best]
            scores[window, rank], ids[window, rank], held[window, rank] = score[order], known[order], True
            full = changed[held[changed, -1]]
            least[full] = np.maximum(low[full], scores[full, -1])
            floor[:] = np.minimum.reduceat(least, since)

        def verify(begin: int, end: int, some: np.ndarray) -> None:
            for places, mine in self._meetings(begin, end, some, labels, same):
                here = rows[places]
                step = max(1, PRODUCTS // len(places))
                for at in range(0, len(mine), step):
                    part = mine[at : at + step]
                    found = products(here, asked[part], kind is not None)
                    # Rounded bounds let through more at most; windows are held against whole numbers.
                    fits = found >= floor[part].astype(found.dtype)[:, None]
                    fits &= found <= ceiling[part].astype(found.dtype)[:, None]
                    hits = np.flatnonzero(fits)
                    score, query, place = found.ravel()[hits].astype(np.int64), part[hits // len(places)], places[hits % len(places)]
                    if not same:
                        other = self.labels[place] != labels[query]
                        score, query, place = score[other], query[other], place[other]
                    if len(score):
                        keep(query, place, score)

        begins, ends, tops = self._leaves(directions, reach, floor.astype(np.float64), ceiling.astype(np.float64))
        if len(begins):
            nearest = tops.argmax(axis=1)
            all_ = np.arange(len(queries))
            opens = tops[all_, nearest] > -np.inf
            for leaf in np.unique(nearest[opens]):
                verify(begins[leaf], ends[leaf], np.flatnonzero(opens & (nearest == leaf)))
            tops[all_, nearest] = -np.inf
            for leaf in np.argsort(-tops.max(axis=0), kind="stable"):
                some = np.flatnonzero((tops[:, leaf] >= floor) & (tops[:, leaf] > -np.inf))
                if len(some):
                    verify(begins[leaf], ends[leaf], some)
        return scores, ids, held


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


# -- the index ------------------------------------------------------------------------------------------
def whole_vectors(rows: DataFrame, label: Column, anchor: Column) -> DataFrame:
    """vec_id, label, vector, norm and anchor of the rows that take part: each component x is floor(256 x) as a 64-bit integer.

    Rows with a null vec_id, label or vector, or a null or non-finite component, don't. Equal rows are one row. Components beyond 64
    bits become the nearest such integer. Vectors may differ in length: what one lacks counts as zeros.
    """
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    part = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return part.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        vector.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
    ).mapInArrow(_packed, f"{_ROW}, anchor boolean")


class Index:
    """Candidates in cells and blocks of cover trees, stored; and the cells' pivots and exact radii."""

    def __init__(self, rows: DataFrame, keep: int):
        """``rows`` as ``whole_vectors`` gives them. Of rows equal in label and vector, and so in every score, no more than
        the ``keep`` with the smallest vec_ids can be among the first ``keep`` of anything; only they are candidates."""
        spark = rows.sparkSession
        equal = Window.partitionBy("label", "vector").orderBy("vec_id")
        rows = rows.distinct().withColumn("n", F.row_number().over(equal)).where(F.col("n") <= keep).drop("n")
        rows = stage(rows, "candidates")
        facts = rows.agg(F.max("norm").alias("norm"), F.max(F.floor(F.octet_length("vector") / 8)).alias("width")).first()
        self.spark, self.sphere = spark, Sphere(facts["norm"] or 0.0, int(facts["width"] or 0))
        sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label").limit(SAMPLE_ROWS).collect()
        self.sample = [(r["label"], bytes(r["vector"])) for r in sample]
        self.pivots = self._pivots()
        dealt = stage(rows.mapInArrow(self._deal(), f"cell int, far double, {_ROW}"), "cells")
        self.cells: dict[int, tuple[float, int]] = {}  # one row per pivot: radius and blocks
        for r in dealt.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect():
            self.cells[r["cell"]] = r["radius"], -(-r["n"] // BLOCK_ROWS)
        cells = spark.createDataFrame([(k, n) for k, (_, n) in sorted(self.cells.items())], "cell int, blocks long")
        placed = dealt.join(F.broadcast(cells), "cell").withColumn("block", F.expr("pmod(xxhash64(vec_id), blocks)"))
        self.blocks = stage(placed.groupBy("cell", "block").applyInArrow(self._grow(), BLOCK), "blocks")

    def _pivots(self) -> np.ndarray:
        """Points of the sample, each as far as can be from those before it: the top level of the tree."""
        points = self.sphere.candidates(matrix([vector for _, vector in self.sample], self.sphere.width))
        chosen = points[:1]
        near = angles(points, points[0]) if len(points) else np.empty(0)
        while len(chosen) < PIVOTS and len(near) and near.max() > 1e-7:
            at = int(near.argmax())
            chosen = np.vstack([chosen, points[at : at + 1]])
            near = np.minimum(near, angles(points, points[at]))
        return chosen

    def _deal(self):
        pivots, sphere = self.pivots, self.sphere

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = sphere.candidates(matrix(batch.column("vector").to_pylist(), sphere.width))
                cosines = rows @ pivots.T
                cell = cosines.argmax(axis=1)
                far = np.arccos(np.clip(cosines[np.arange(len(cell)), cell], -1, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(far), *(batch.column(name) for name in _NAMES)],
                    names=["cell", "far", *_NAMES],
                )

        return run

    def _grow(self):
        sphere = self.sphere

        def run(table: pa.Table) -> pa.Table:
            vectors = table.column("vector").to_pylist()
            order, nodes = cover_tree(sphere.candidates(matrix(vectors, sphere.width)))
            centres = [vectors[int(k)] for k in nodes[:, 0]]
            vectors = [vectors[k] for k in order]
            ids, labels = (table.column(name).to_numpy()[order].astype("<i8").tobytes() for name in ("vec_id", "label"))
            lists = pa.list_(pa.binary())
            return pa.table(
                {
                    "cell": table.column("cell").slice(0, 1),
                    "block": table.column("block").slice(0, 1),
                    "ids": pa.array([ids], pa.binary()),
                    "labels": pa.array([labels], pa.binary()),
                    "vectors": pa.array([vectors], lists),
                    "nodes": pa.array([nodes.astype("<f8").tobytes()], pa.binary()),
                    "centres": pa.array([centres], lists),
                }
            )

        return run

    def _route(self, windows: bool, count: int):
        """The cells and blocks that a query has to open, as rows of (cell, block, queries of a batch)."""
        sphere, cells, sample = self.sphere, sorted(self.cells.items()), self.sample
        numbers = np.array([k for k, _ in cells], int)
        radius = np.array([one[0] for _, one in cells])
        centres = self.pivots[numbers] if len(cells) else np.empty((0, sphere.width + 1))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = matrix([vector for _, vector in sample])
            labels = np.array([label for label, _ in sample], np.int64)
            largest = longest(known)
            for batch in batches:
                for at in range(0, batch.num_rows, ROUTED):
                    part = batch.slice(at, ROUTED)
                    vectors, own, ids = (part.column(name).to_pylist() for name in ("vector", "label", "class"))
                    rows = matrix(vectors)
                    directions, reach = sphere.queries(rows)
                    low, high = bounds(np.arccos(np.clip(directions @ centres.T, -1, 1)), radius, reach[:, None])
                    kind = exact_type(largest, longest(rows))
                    scores = products(known, rows, False) if kind is None else products(known.astype(kind), rows.astype(kind), True)
                    asked = part.column("windows").to_pylist() if windows else [[dict(_WHOLE)] for _ in ids]
                    opened = np.zeros(low.shape, bool)
                    for k, some in enumerate(asked):
                        # As many rows as are looked for lie from here on in the sample alone.
                        there = np.sort(scores[k][(labels == own[k]) != windows].astype(np.int64))
                        for one in some:
                            one["low"] = _raised(there, one["low"], one["high"], count)
                            opened[k] |= (high[k] >= one["low"]) & (low[k] <= one["high"])
                    packs, of_pack = [], []
                    for c in range(len(cells)):
                        chosen = np.flatnonzero(opened[:, c]).tolist()
                        if not chosen:
                            continue
                        spans = [(at, w) for at, k in enumerate(chosen) for w in asked[k]]
                        pack = {
                            "class": [ids[k] for k in chosen],
                            "label": [own[k] for k in chosen],
                            "vector": [vectors[k] for k in chosen],
                            "owner": [at for at, _ in spans],
                            **{name: [w[name] for _, w in spans] for name in ("score", "low", "high")},
                        }
                        of_pack += [(int(numbers[c]), block, ids[chosen[0]], len(packs)) for block in range(cells[c][1][1])]
                        packs.append(pack)
                    if packs:
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([r[0] for r in of_pack], pa.int32()),
                                pa.array([r[1] for r in of_pack], pa.int64()),
                                pa.array([r[2] for r in of_pack], pa.int64()),
                                pa.array(packs, _QUERIES).take(pa.array([r[3] for r in of_pack])),
                            ],
                            names=["cell", "block", "first", "queries"],
                        )

        return run

    def search(self, queries: DataFrame, count: int, windows: bool) -> DataFrame:
        """class, positive_score (null unless ``windows``), score and vec_id of the first ``count`` rows that a class looks for.

        ``queries``: class (a vec_id), label, vector, and with ``windows`` an array of (score, low, high).
        """
        n = queries.count()
        chunks = max(1, -(-n // QUERIES_TOGETHER))
        routed = queries.mapInArrow(self._route(windows, count), "cell int, block long, first long, queries " + _QUERIES_DDL)
        # So many queries meet a block in a task; a block is read anew for the next ones.
        routed = routed.withColumn("chunk", F.expr(f"pmod(xxhash64(first), {chunks})").cast("int"))
        blocks = self.blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        sphere = self.sphere

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            parts = []
            for block in left.to_pylist():  # one
                tree = Block(
                    np.frombuffer(block["ids"], "<i8"),
                    np.frombuffer(block["labels"], "<i8"),
                    block["vectors"],
                    np.frombuffer(block["nodes"], "<f8").reshape(-1, 6),
                    block["centres"],
                    sphere,
                )
                packs = right.column("queries").to_pylist()
                if packs:
                    # All queries of the cell at once; windows of later packs belong to later queries.
                    asked = {name: [one for pack in packs for one in pack[name]] for name in packs[0]}
                    before = np.cumsum([0, *(len(pack["class"]) for pack in packs)])
                    asked["owner"] = [at + int(first) for pack, first in zip(packs, before) for at in pack["owner"]]
                    rows = matrix(asked["vector"])
                    directions, reach = sphere.queries(rows)
                    owner, labels, classes = (np.array(asked[name], np.int64) for name in ("owner", "label", "class"))
                    low, high = (np.array(asked[name], np.int64) for name in ("low", "high"))
                    scores, found, held = tree.first(rows, directions, reach, labels, low, high, not windows, count, owner)
                    at, place = np.nonzero(held)
                    of_window = pa.array(asked["score"], pa.int64()).take(pa.array(at))
                    parts.append((pa.array(classes[owner][at]), of_window, pa.array(scores[at, place]), pa.array(found[at, place])))
            names = ("class", "positive_score", "score", "vec_id")
            return pa.table(
                {name: pa.concat_arrays([pa.array([], pa.int64()), *(part[k] for part in parts)]) for k, name in enumerate(names)}
            )

        keys = ["cell", "block", "chunk"]
        found = (
            blocks.groupBy(*keys)
            .cogroup(routed.groupBy(*keys))
            .applyInArrow(run, "class long, positive_score long, score long, vec_id long")
        )
        first = Window.partitionBy("class", "positive_score").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= count)


def _raised(scores: np.ndarray, low: int, high: int, count: int) -> int:
    """The ``count``-th greatest of ascending scores from ``low`` to ``high``, or ``low`` if there are fewer."""
    end = int(np.searchsorted(scores, high, "right"))
    return max(low, int(scores[end - count])) if end >= count else low


#: Any score.
_WHOLE = {"score": None, "low": -(1 << 63), "high": (1 << 63) - 1}
_NAMES = ["vec_id", "label", "vector", "norm"]
BLOCK = "cell int, block long, ids binary, labels binary, vectors array<binary>, nodes binary, centres array<binary>"
_LONGS = ("class", "label", "owner", "score", "low", "high")
_QUERIES_DDL = f"struct<{','.join(f'{name}:array<bigint>' for name in _LONGS)},vector:array<binary>>"
_QUERIES = pa.struct([*((name, pa.list_(pa.int64())) for name in _LONGS), ("vector", pa.list_(pa.binary()))])


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, exactly.

    ``rows``: vec_id, embedding. ``anchor`` (a condition) and ``label`` are expressions over their columns. An anchor's positives are its
    first ``positives`` other rows (by vec_id) of the same label, by inner product of whole vectors (see ``whole_vectors``), ties by
    smaller vec_id. For each of them, the first ``negatives`` rows of other labels with scores from ``low`` to ``high``
    percent of the positive's, by the same order. Pairs without any such row give none. A vec_id that occurs with different vectors
    is a row each. Scores beyond 64 bits become the nearest such integer. No rows give no rows; other columns are ignored.

    Anchors equal in label and vector look for the same rows, and are searched once.
    """
    vectors = stage(whole_vectors(rows, label, anchor), "vectors")
    index = Index(vectors.drop("anchor"), max(positives + 1, negatives))
    anchors = vectors.where("anchor").select("vec_id", "label", "vector").distinct()
    # Stored, so that the numbers stay.
    classes = stage(
        anchors.select("label", "vector").distinct().withColumn("class", F.monotonically_increasing_id()), "classes"
    )
    anchors = anchors.join(classes, ["label", "vector"]).select(F.col("vec_id").alias("anchor_id"), "class")
    best = stage(index.search(classes.repartition(F.col("class")), positives + 1, False), "positives")
    listed = best.groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", F.col("score").alias("positive_score")))).alias("best")
    )
    others = F.filter("best", lambda row: row["vec_id"] != F.col("anchor_id"))
    pairs = stage(
        anchors.join(listed, "class")
        .select("class", "anchor_id", F.explode(F.slice(others, 1, positives)).alias("positive"))
        .select("class", "anchor_id", F.col("positive.vec_id").alias("positive_id"), "positive.positive_score"),
        "pairs",
    )
    score = F.col("positive_score").cast("decimal(25,0)")
    window = F.struct(
        F.col("positive_score").alias("score"),
        F.ceil(score * low / 100).cast("long").alias("low"),
        F.floor(score * high / 100).cast("long").alias("high"),
    )
    spans = (
        pairs.select("class", window.alias("window"))
        .distinct()
        .where("window.low <= window.high")
        .groupBy("class")
        .agg(F.sort_array(F.collect_list("window")).alias("windows"))  # as many as a class has positives, at most
    )
    found = index.search(classes.join(spans, "class").repartition(F.col("class")), negatives, True).select(
        "class",
        "positive_score",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    return pairs.join(stage(found, "negatives"), ["class", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
