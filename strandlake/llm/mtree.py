"""Exact search for the largest integer inner products, best first over a paged M-tree.

With one more component, sqrt(R^2 - |x|^2) for a row and 0 for a query, R being the largest length of all rows, the
square of the distance of q and x is |q|^2 + R^2 - 2 q.x: the largest product is the nearest point, and the triangle
inequality holds. The tree has four kinds of levels:

* the root's routing objects are rows chosen from a bounded sample; every row belongs to its nearest one;
* rows sorted by that object and their distance to it are cut into pages, so a page is a ring around its parent. It
  keeps the ring, a routing object of its own and its covering radius. Some pages in a row are a group, one task's
  share;
* a page holds leaf nodes, each with a routing object, a covering radius and its distance to the page's;
* a leaf holds entries with their distance to the leaf's routing object.

A query searches the group that it most likely belongs to first. What it finds bounds the distance of use, and the ring
of every other group tells whether the query goes there. In a group, pages and leaves wait in a queue by the least
distance they allow; stored distances to the parent rule out nodes and entries whose own distance is then never
computed. Products are exact; bounds have a slack above their rounding. So is the result.

Equal vectors are one entry with the k + 1 smallest ids, since no others can be in a result. Vectors of each size have
a tree of their own.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch, prepare, sliced

#: The factor before components are rounded down.
SCALE = 256
RESULT = "query_id long, rank int, vec_id long, score long"
FOUND = "c string, score long, vec_id long"
_EXACT = float(1 << 53)


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.array(column.flatten(), dtype=np.float64).reshape(rows, -1)


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a and b."""
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lifted(x: np.ndarray, radius2: float) -> np.ndarray:
    """Rows with the component that gives them all the same length."""
    return np.hstack((x, np.sqrt(np.maximum(radius2 - (x * x).sum(1), 0))[:, None]))


def spread_out(points: np.ndarray, many: int) -> np.ndarray:
    """Places of ``many`` points, each as far as can be from those before."""
    chosen = [0]
    away = between(points, points[:1])[:, 0]
    while len(chosen) < min(many, len(points)):
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, between(points, points[chosen[-1:]])[:, 0])
    return np.array(chosen)


@dataclass
class Page:
    """Entries of a page by leaf. ``near`` and ``far``: their least and largest distance to the root's object."""

    near: float
    far: float
    center: np.ndarray
    radius: float
    leaf_at: np.ndarray  # first entry of each leaf, and the end
    leaf_center: np.ndarray
    leaf_radius: np.ndarray
    leaf_up: np.ndarray  # distances of the leaves' objects to the page's
    entry_up: np.ndarray  # distances of entries to their leaf's object
    x: np.ndarray
    ids: list[list[int]]


def make_page(x: np.ndarray, up: np.ndarray, ids: list[list[int]], radius2: float, leaf: int) -> Page:
    points = lifted(x, radius2)
    routing = spread_out(points, -(-len(x) // leaf))
    away = between(points, points[routing])
    own = np.argmin(away, axis=1)
    order = np.argsort(own, kind="stable")
    own, to_leaf = own[order], away[order, own[order]]
    used, leaf_at = np.unique(own, return_index=True)
    to_page = away[:, 0]
    radii = np.maximum.reduceat(to_leaf, leaf_at)
    return Page(float(up.min()), float(up.max()), points[routing[0]], float(to_page.max()), np.append(leaf_at, len(x)), points[routing[used]], radii, to_page[routing[used]], to_leaf, np.ascontiguousarray(x[order]), [ids[i] for i in order])


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products as whole numbers; those beyond a long are cut to its range."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1)
    if most < _EXACT:
        return (x @ q).astype(np.int64)
    whole = [int(v) for v in q]
    sums = (sum(int(a) * b for a, b in zip(row, whole, strict=True)) for row in x)
    return np.array([min(max(s, -(1 << 63)), (1 << 63) - 1) for s in sums], np.int64)


class Search:
    """The ``most`` best (score, id) of a query among pages, none of which needs a score below ``floor``. ``computed``
    counts the distances and products that were needed."""

    def __init__(self, q: np.ndarray, most: int, floor: float, radius2: float):
        self.q, self.most, self.floor = q, most, floor
        self.point = np.append(q, 0.0)
        self.square, self.slack = float(q @ q) + radius2, 1e-6 * (1 + radius2**0.5 + float(q @ q) ** 0.5)
        self.best: list[tuple[int, int]] = []  # (score, -id), the worst first
        self.computed = 0

    def reach(self) -> float:
        """No point further off can be in the result."""
        score = max(self.floor, self.best[0][0]) if len(self.best) == self.most else self.floor
        return float("inf") if score == -np.inf else max(self.square - 2 * score, 0.0) ** 0.5 + self.slack

    def distances(self, centers: np.ndarray) -> np.ndarray:
        self.computed += len(centers)
        return between(centers, self.point[None])[:, 0]

    def run(self, pages: list[Page], to_root: float) -> list[tuple[int, int]]:
        reach = self.reach()
        open_pages = [i for i, p in enumerate(pages) if max(p.near - to_root, to_root - p.far) <= reach]
        if not open_pages:
            return []
        away = self.distances(np.stack([pages[i].center for i in open_pages]))
        queue = [(max(d - pages[i].radius, 0.0), i, -1, d) for i, d in zip(open_pages, away.tolist(), strict=True)]
        heapq.heapify(queue)
        while queue:
            least, i, leaf, d = heapq.heappop(queue)
            reach = self.reach()
            if least > reach:
                break
            page = pages[i]
            if leaf < 0:
                leaves = np.flatnonzero(np.abs(d - page.leaf_up) - page.leaf_radius <= reach)
                if len(leaves):
                    away = self.distances(page.leaf_center[leaves])
                    for j, dj, rj in zip(leaves.tolist(), away.tolist(), page.leaf_radius[leaves].tolist(), strict=True):
                        if dj - rj <= reach:
                            heapq.heappush(queue, (max(dj - rj, 0.0), i, j, dj))
                continue
            at = page.leaf_at[leaf]
            rows = at + np.flatnonzero(np.abs(d - page.entry_up[at : page.leaf_at[leaf + 1]]) <= reach)
            if len(rows):
                self.computed += len(rows)
                self.take(page, rows, products(page.x[rows], self.q))
        return self.best

    def take(self, page: Page, rows: np.ndarray, scores: np.ndarray) -> None:
        floor = max(self.floor, self.best[0][0] if len(self.best) == self.most else -np.inf)
        good = np.flatnonzero(scores >= floor)
        for k in good[np.argsort(-scores[good], kind="stable")].tolist():
            score = int(scores[k])
            if len(self.best) == self.most and score < self.best[0][0]:
                break
            for i in page.ids[rows[k]]:
                if len(self.best) < self.most:
                    heapq.heappush(self.best, (score, -i))
                elif (score, -i) > self.best[0]:
                    heapq.heapreplace(self.best, (score, -i))


@dataclass
class Root:
    """The root's routing objects, and the least and largest distance of the rows of each (set when they are known)."""

    objects: np.ndarray
    radius2: float

    def to(self, x: np.ndarray) -> np.ndarray:
        """Distances of queries."""
        return between(np.hstack((x, np.zeros((len(x), 1)))), lifted(self.objects, self.radius2))

    def floors(self, x: np.ndarray, most: int) -> np.ndarray:
        """Scores that each query's result reaches, as its products with the routing objects, which are rows, do."""
        if len(self.objects) < most:
            return np.full(len(x), -np.inf)
        score = np.stack([products(self.objects, q) for q in x]) if len(x) else np.empty((0, len(self.objects)))
        return np.partition(score, -most, axis=1)[:, -most].astype(float)


def usable(vector: Column) -> Column:
    """Not null, all components there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def top_products(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = 4096, objects: int = 512, page: int = 2048, leaf: int = 128, group: int = 8, queries_at_once: int = 1 << 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k largest integer inner products of each query with the other rows: query_id, rank, vec_id, score. A
    component x counts as floor(256 * x).

    The root's routing objects are one for each ``page`` rows, at most ``objects``, chosen from at most some ``sample``
    rows. A page holds ``page`` vectors, a leaf some ``leaf``, a group ``group`` pages; of queries in a group each
    ``queries_at_once`` or so may go to another task. None of these changes the result.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id; zero and
    empty vectors do. Only vectors of one size are compared, each size by itself. Repeated rows count once; an id with
    two vectors is two candidates and, as a query, two queries under one id. Rows of the query's own id are no
    candidates. Equal scores are ordered by id. Fewer than k others give them all; no rows give none. Components and
    scores beyond a long are cut to its range.
    """
    spark = vectors.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "mtree")
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q")).filter(F.col("id").isNotNull() & usable(F.col("v")))
    v = v.select("id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("x"), "q")
    v = scratch.write(v.withColumn("c", F.concat_ws("-", F.size("x"), F.hex(F.xxhash64("x")), F.hex(F.xxhash64("x", F.lit(1))))), "vectors")
    # copies of a vector: the ids that a result can name
    ranked = v.withColumn("n", F.dense_rank().over(Window.partitionBy("c").orderBy("id"))).filter(F.col("n") <= k + 1)
    classes = scratch.write(ranked.groupBy("c").agg(F.first("x").alias("x"), F.array_sort(F.collect_set("id")).alias("ids")), "classes")
    length2 = F.aggregate("x", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    found = None
    for size in classes.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("n"), F.max(length2).alias("radius2")).orderBy("dims").collect():
        of_size = F.size("x") == size["dims"]
        queries = v.filter(F.col("q") & of_size).dropDuplicates(["c"]).select("c", "x")
        one = _search_size(scratch, classes.filter(of_size), scratch.write(queries, f"queries{size['dims']}"), size["n"], size["radius2"], k + 1, sample, objects, page, leaf, group, queries_at_once)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], RESULT)
    by_score = Window.partitionBy("c").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k + 1)
    best = F.array_sort(F.collect_list(F.struct(F.col("n"), "vec_id", "score")))
    top = scratch.write(top.groupBy("c").agg(best.alias("best")), "best")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    mine = v.filter("q").select(F.col("id").alias("query_id"), "c").distinct().join(top, "c").select("query_id", F.posexplode(others).alias("at", "b"))
    return mine.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))


def _search_size(scratch: Scratch, classes: DataFrame, queries: DataFrame, n: int, radius2: float, most: int, sample: int, objects: int, page: int, leaf: int, group: int, queries_at_once: int) -> DataFrame:
    """(c, score, vec_id): the ``most`` best of each query among vectors of its size, and some more."""
    spark = classes.sparkSession
    picked = classes.filter((F.shiftrightunsigned(F.xxhash64("c"), 11) / float(1 << 53)) < min(1.0, sample / n)).select("x").toArrow()["x"].combine_chunks()
    points = matrix(picked, len(picked)) if len(picked) else matrix(classes.select("x").limit(1).toArrow()["x"].combine_chunks(), 1)
    many = max(1, min(objects, n // page, len(points)))
    root = Root(points[spread_out(lifted(points, radius2), many)], radius2)
    shared = spark.sparkContext.broadcast(root)
    tag = str(points.shape[1])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            x = matrix(batch.column("x"), len(batch))
            away = between(lifted(x, radius2), lifted(shared.value.objects, radius2))
            cell = np.argmin(away, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(x)), cell]), *(batch.column(c) for c in ("c", "x", "ids"))], ["cell", "up", "c", "x", "ids"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages of sorted rows; a group's rows have one cell."""
        from pyspark import TaskContext

        part, made, in_group = TaskContext.get().partitionId(), 0, 0
        cell, held = None, []

        def emit() -> pa.RecordBatch:
            x, up, ids = (list(chain.from_iterable(h[i] for h in held)) for i in range(3))
            one = make_page(np.array(x).reshape(len(up), -1), np.array(up), ids, radius2, leaf)
            row = {"g": [f"{tag}-{part}-{made}"], "cell": [cell], "near": [one.near], "far": [one.far], "page": [pickle.dumps(one)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("g", pa.string()), ("cell", pa.int32()), ("near", pa.float64()), ("far", pa.float64()), ("page", pa.binary())]))

        for batch in batches:
            cells, at = np.array(batch.column("cell")), 0
            while at < len(cells):
                if cells[at] != cell:
                    if held:
                        yield emit()
                        held = []
                    cell, in_group, made = int(cells[at]), 0, made + 1
                room = page - sum(len(h[1]) for h in held)
                end = min(at + room, int(np.searchsorted(cells, cell, side="right")))
                piece = batch.slice(at, end - at)
                held.append((list(matrix(piece.column("x"), len(piece))), np.array(piece.column("up")), piece.column("ids").to_pylist()))
                at = end
                if sum(len(h[1]) for h in held) == page:
                    yield emit()
                    held, in_group = [], in_group + 1
                    if in_group == group:
                        in_group, made = 0, made + 1
        if held:
            yield emit()

    placed = classes.select("c", "x", "ids").mapInArrow(assign, "cell int, up double, c string, x array<long>, ids array<long>")
    rows = placed.repartitionByRange("cell", "up", "c").sortWithinPartitions("cell", "up", "c")
    pages = scratch.write(rows.mapInArrow(cut, "g string, cell int, near double, far double, page binary"), f"pages{tag}")
    groups = scratch.write(pages.groupBy("g", "cell").agg(F.min("near").alias("near"), F.max("far").alias("far")), f"groups{tag}")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's distance to each routing object, the nearest one first."""
        for batch in sliced(batches, 500):
            x = matrix(batch.column("x"), len(batch))
            away, floors = shared.value.to(x), shared.value.floors(x, most)
            cells = np.argsort(away, axis=1, kind="stable")
            m = cells.shape[1]
            q = pa.array(np.repeat(np.arange(len(x)), m))
            flat = np.take_along_axis(away, cells, axis=1).ravel()
            yield pa.RecordBatch.from_arrays([batch.column("c").take(q), pa.array(cells.ravel().astype(np.int32)), pa.array(np.tile(np.arange(m, dtype=np.int32), len(x))), pa.array(flat), pa.array(np.repeat(floors, m)), pa.array(np.repeat((x * x).sum(1), m))], ["c", "cell", "place", "to_root", "floor", "square"])

    asked = scratch.write(queries.mapInArrow(ask, "c string, cell int, place int, to_root double, floor double, square double"), f"asked{tag}")
    ring = F.greatest(F.col("near") - F.col("to_root"), F.col("to_root") - F.col("far"), F.lit(0.0))
    home = asked.filter("place = 0").join(groups, "cell").groupBy("c").agg(F.min_by(F.struct("g", "to_root", "floor"), F.struct(ring, "far", "g")).alias("h"))
    home = scratch.write(home.select("c", "h.*"), f"home{tag}")
    shares = -(-max(queries.count(), 1) // queries_at_once)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group's pages come first, then its queries, one by one."""
        now, pages_now = None, []
        for batch in sliced(batches, 500):
            out = []
            xs = batch.column("x")
            for i, (g, c, blob, to_root, floor) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("key", "c", "page", "to_root", "floor")), strict=True)):
                if g != now:
                    now, pages_now = g, []
                if blob is not None:
                    pages_now.append(pickle.loads(blob))
                else:
                    q = np.array(xs[i].values, dtype=np.float64)
                    best = Search(q, most, floor, radius2).run(pages_now, to_root)
                    out += [(c, score, -i) for score, i in best]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["c", "score", "vec_id"])

    def look(wanted: DataFrame, name: str) -> DataFrame:
        """wanted: (c, g, to_root, floor)."""
        share = F.pmod(F.xxhash64("c"), F.lit(shares))
        asks = wanted.join(queries, "c").select(F.concat_ws("-", "g", share).alias("key"), F.lit(1).alias("role"), "c", "x", "to_root", "floor", F.lit(None).cast("binary").alias("page"))
        every = F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))
        given = pages.join(wanted.select("g").distinct(), "g", "left_semi").select("g", every.alias("share"), "page")
        given = given.select(F.concat_ws("-", "g", "share").alias("key"), F.lit(0).alias("role"), F.lit("").alias("c"), F.array().cast("array<long>").alias("x"), F.lit(0.0).alias("to_root"), F.lit(0.0).alias("floor"), "page")
        dealt = given.unionByName(asks).repartition("key").sortWithinPartitions("key", "role")
        return scratch.write(dealt.mapInArrow(search, FOUND), name)

    first = look(home, f"first{tag}")
    # the worst of what a query has found bounds what it still needs
    bounds = first.groupBy("c").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
    bounds = home.join(bounds, "c", "left").select("c", F.col("g").alias("seen"), F.when(F.col("n") >= most, F.greatest(F.col("worst").cast("double"), "floor")).otherwise(F.col("floor")).alias("floor"))
    square = F.col("square") + radius2
    slack = 1e-6 * (1 + radius2**0.5 + F.sqrt("square"))
    reach = F.sqrt(F.greatest(square - 2 * F.col("floor"), F.lit(0.0))) + slack
    rest = asked.drop("floor").join(bounds, "c").join(groups, "cell").filter((F.col("g") != F.col("seen")) & (ring <= reach)).select("c", "g", "to_root", "floor")
    return first.unionByName(look(scratch.write(rest, f"rest{tag}"), f"second{tag}"))


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
