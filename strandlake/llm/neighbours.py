"""Approximate nearest neighbours: inverted lists, scanned by adaptive dimensions.

Centroids are fitted on a bounded sample; every vector is put into the list of its nearest centroid. A query probes
the nearest lists. Within a list the rotated vectors are read in blocks of columns; after each block a hypothesis
test on the partial distance abandons the candidates that are unlikely to be among the nearest, and only the rest
read the next block. What is left is scored exactly on the original vectors.

Equal vectors are one candidate with the k + 1 smallest ids, since no others can be in a result, and equal queries
are searched once; so copies of one vector don't fill a list. Large lists are cut into chunks and their queries
into blocks, each pair of which is one task's group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch, prepare, sliced

GROUP = 4096


@dataclass
class Index:
    centroids: np.ndarray
    rotation: np.ndarray


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def fit_index(sample: np.ndarray, lists: int, rounds: int = 8) -> Index:
    """Spherical k-means and a random rotation."""
    rng = np.random.Generator(np.random.PCG64(5))
    rotation, _ = np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))
    sample = unit(sample)
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(rounds):
        own = np.argmax(sample @ centroids.T, axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, own, sample)
        size = np.linalg.norm(total, axis=1)
        centroids = np.where(size[:, None] > 1e-12, total / np.maximum(size, 1e-12)[:, None], centroids)
    return Index(centroids, rotation)


def probes_for(queries: np.ndarray, points: np.ndarray, index: Index, k: int, recall: float) -> int:
    """How many lists, nearest first, hold the share ``recall`` of the queries' k nearest points by brute force. A
    point equal to the query doesn't count."""
    points, lists = unit(points), len(index.centroids)
    if not len(queries) or len(points) <= k:
        return lists
    own = np.argmax(points @ index.centroids.T, axis=1)
    places = []
    for at in range(0, len(queries), 64):
        q = unit(queries[at : at + 64])
        score = q @ points.T
        score[score > 1 - 1e-12] = -np.inf
        near = np.argpartition(-score, k - 1, axis=1)[:, :k]
        place = np.argsort(np.argsort(-(q @ index.centroids.T), axis=1, kind="stable"), axis=1)
        places.append(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(np.quantile(np.concatenate(places), recall, method="higher")) + 1


def scan(rotated: np.ndarray, query: np.ndarray, k: int, block: int, epsilon: float, first: int = 128, rows_at_once: int = 1024) -> np.ndarray:
    """Rows that may be among the k nearest of a query; both rotated and of unit length."""
    dims = rotated.shape[1]
    if len(rotated) <= k:
        return np.arange(len(rotated))
    kept_rows: list[np.ndarray] = []
    best = np.empty(0)
    for at in range(0, len(rotated), rows_at_once):
        part = rotated[at : at + rows_at_once]
        rows = np.arange(len(part))
        partial = np.zeros(len(part))
        bound = best[k - 1] if len(best) >= k else np.inf
        if not np.isfinite(bound):  # the first candidates set the bound
            d = ((part[:first] - query) ** 2).sum(1)
            if len(d) >= k:
                bound = np.partition(d, k - 1)[k - 1]
        for lo in range(0, dims, block):
            hi = min(lo + block, dims)
            partial = partial + ((part[rows, lo:hi] - query[lo:hi]) ** 2).sum(1)
            limit = bound if hi == dims else bound * (hi / dims) * (1 + epsilon / np.sqrt(hi)) ** 2
            alive = partial <= limit * (1 + 1e-9) + 1e-12
            rows, partial = rows[alive], partial[alive]
        best = np.sort(np.concatenate((best, partial)))[:k]
        kept_rows.append(rows + at)
    return np.concatenate(kept_rows)


def valid(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, lists: int | None = None, probe_share: float | None = None, recall: float = 0.97, sample: int = 20_000, held: int = 512, block: int = 16, epsilon: float = 2.5, group: int = GROUP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k nearest other rows of each query by cosine: query_id, rank, vec_id, score.

    ``lists`` is a third of the square root of the number of distinct vectors unless given, ``sample`` the bound of
    vectors that the index is fitted on, ``group`` how many rows and how many queries of a list meet in one task's
    group. A query probes as many lists as held the share ``recall`` of the nearest among the sample for up to
    ``held`` vectors of it (at most a quarter) that the lists weren't fitted on, or the share ``probe_share`` of the
    lists if given (1.0 leaves no list out), and always enough to hold k + 1 ids. Vectors that are null, zero, or hold null or non-finite components take no part, nor do those without an id
    or of another size than the most frequent one. Repeated rows count once. Fewer than k others give them all; no
    rows give none. Equal scores are ordered by id.
    """
    spark = vectors.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "neighbours")
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), is_query.alias("q")).filter(F.col("id").isNotNull() & valid(F.col("v")))
    sizes = sorted(((r["count"], r["n"]) for r in v.groupBy(F.size("v").alias("n")).count().collect()), reverse=True)
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    v = v.filter(F.size("v") == sizes[0][1])
    v = v.withColumn("c", F.concat_ws("-", F.hex(F.xxhash64("v")), F.hex(F.xxhash64("v", F.lit(1)))))
    ranked = v.withColumn("n", F.dense_rank().over(Window.partitionBy("c").orderBy("id"))).filter(F.col("n") <= k + 1)
    classes = scratch.write(ranked.groupBy("c").agg(F.first("v").alias("v"), F.array_sort(F.collect_set("id")).alias("ids")), "classes")
    n = classes.count()
    picked = classes.filter((F.shiftrightunsigned(F.xxhash64("c"), 11) / float(1 << 53)) < min(1.0, sample / n)).select("v").toArrow()["v"]
    points = np.array(picked.combine_chunks().flatten()).reshape(len(picked), -1) if len(picked) else np.array(classes.select("v").first()["v"])[None]
    lists = max(1, min(lists or round(n**0.5 / 3), len(points)))
    held = min(held, len(points) // 4)
    lists = min(lists, len(points) - held)
    index = fit_index(points[held:], lists)
    probes = probes_for(points[:held], points, index, k, recall) if probe_share is None else max(1, round(lists * probe_share))
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            x = unit(np.array(batch.column("v").flatten()).reshape(len(batch), -1))
            own = np.argmax(x @ shared.value.centroids.T, axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], ["c", "v", "ids", "list"])

    placed = scratch.write(classes.select("c", "v", "ids").mapInArrow(assign, "c string, v array<double>, ids array<long>, list int"), "placed")
    ids_in = np.zeros(lists, int)
    parts = np.ones(lists, int)
    for r in placed.groupBy("list").agg(F.sum(F.size("ids")).alias("ids"), F.count("*").alias("n")).collect():
        ids_in[r["list"]], parts[r["list"]] = r["ids"], -(-r["n"] // group)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2000):
            x = unit(np.array(batch.column("v").flatten()).reshape(len(batch), -1))
            order = np.argsort(-(x @ shared.value.centroids.T), axis=1, kind="stable")
            enough = np.argmax(np.cumsum(ids_in[order], axis=1) >= min(k + 1, ids_in.sum()), axis=1) + 1
            many = np.maximum(probes, enough)
            rows = np.repeat(np.arange(len(x)), many)
            found = np.concatenate([o[:m] for o, m in zip(order, many, strict=True)]).astype(np.int32) if len(x) else np.empty(0, np.int32)
            full = ids_in[found] > 0
            yield pa.RecordBatch.from_arrays([batch.column("c").take(pa.array(rows[full])), pa.array(found[full])], ["c", "list"])

    asked = v.filter("q").select("id", "c").distinct()
    queries = v.filter("q").dropDuplicates(["c"]).select("c", "v")
    wanted = scratch.write(queries.mapInArrow(probe, "c string, list int"), "wanted")
    blocks = np.ones(lists, int)
    for r in wanted.groupBy("list").count().collect():
        blocks[r["list"]] = -(-r["count"] // group)
    splits = spark.createDataFrame([(i, int(p), int(b)) for i, (p, b) in enumerate(zip(parts, blocks, strict=True))], "list int, parts int, blocks int")
    splits = F.broadcast(splits)  # one row per list; their number is bounded by the sample
    rows_of = placed.join(splits, "list").select("list", F.pmod(F.xxhash64("c"), "parts").cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "c", "v", "ids")
    asks_of = wanted.join(splits, "list").join(queries, "c").select("list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.pmod(F.xxhash64("c"), "blocks").cast("int").alias("block"), "c", "v", F.lit(None).cast("array<long>").alias("ids"))

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("ids").to_pylist()
        names = table.column("c").to_pylist()
        x = np.array(table.column("v").combine_chunks().flatten()).reshape(len(ids), -1)
        is_row = np.array([i is not None for i in ids])
        rows, asks = np.flatnonzero(is_row), np.flatnonzero(~is_row)
        out: list[tuple[str, float, list[int]]] = []
        if len(rows) and len(asks):
            length = np.linalg.norm(x, axis=1)
            turned = (x / length[:, None]) @ shared.value.rotation
            turned_rows = np.ascontiguousarray(turned[rows])
            for a in asks:
                near = rows[scan(turned_rows, turned[a], k + 1, block, epsilon)]
                score = (x[near] @ x[a]) / (length[near] * length[a])
                best = sorted(zip(-score, [ids[r][0] for r in near], near, strict=True))[: k + 1]
                out += [(names[a], float(-s), ids[r]) for s, _, r in best]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.list_(pa.int64()))], names=["c", "score", "ids"])

    found = rows_of.unionByName(asks_of).groupBy("list", "part", "block").applyInArrow(search, "c string, score double, ids array<long>")
    each = found.select("c", "score", F.explode("ids").alias("vec_id"))
    by_score = Window.partitionBy("c").orderBy(F.desc("score"), "vec_id")
    top = each.withColumn("n", F.row_number().over(by_score)).filter(F.col("n") <= k + 1)
    # at most k + 1 rows of a vector; written, so Spark may split a vector that very many queries share
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id")))
    top = scratch.write(top.groupBy("c").agg(best.alias("best")), "best")
    others = F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k)
    mine = asked.withColumnRenamed("id", "query_id").join(top, "c").select("query_id", F.posexplode(others).alias("at", "b"))
    return mine.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score"))
