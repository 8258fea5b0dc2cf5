"""Prefix tries of conversations.

A node is a distinct sequence of first turns; its members are the conversations that start with it. Turns are told by
128-bit digests, so texts don't leave the task that reads them. Equal conversations are collapsed to one weighted
sequence first. Sequences are hash-partitioned by the digest of their first turn, several first turns to a bucket, and
each bucket is built as a trie of pointer dictionaries inside applyInPandas and summed up in iterative postorder.

A first turn that too many turns stand below would not fit a task. Its sequences share some first turns; that common
trunk is set aside and what is left is dealt anew by the next turn, until all subtries are small. Trunks are summed up
from the tops of their subtries, last ones first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.manifest import crc_sql
from strandlake.llm.runtime import Scratch, prepare

#: Turns that a subtrie may hold.
MOST_TURNS = 1 << 16
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
COLUMNS = [c.split()[0] for c in NODE.split(", ")]
NOTHING = hashlib.sha256(b"").hexdigest()


def short(text: Column) -> Column:
    """The first 16 bytes of SHA-256."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns), turns being structs of d (digest of role and text) and n (code points of the text).

    Turns are in order, null ones first; those of one number stand in the order of their digests. Null roles and texts
    are empty. Repeated rows are turns of their own. Rows without conv_id take no part.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = short(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    place = F.col(turn_col).cast("long")
    one = F.struct(place.isNotNull().alias("known"), F.coalesce(place, F.lit(0)).alias("at"), digest.alias("d"), F.length(text).cast("long").alias("n"))
    rows = conversations.select(F.col(conv_col).cast("long").alias("conv_id"), one.alias("t")).filter(F.col("conv_id").isNotNull())
    sorted_turns = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["d"].alias("d"), t["n"].alias("n")))
    return rows.groupBy("conv_id").agg(sorted_turns.alias("turns"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (s, conv_id) in order: for each s its number of rows, the first one and the digest of all, as a stream."""
    name, made, first, n = None, None, 0, 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([n]), pa.array([first]), pa.array([made.hexdigest()])], ["s", "w", "first", "ends"])

    for batch in batches:
        out = []
        for s, group in groupby(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), key=lambda r: r[0]):
            ids = [c for _, c in group]
            if s != name:
                if made is not None:
                    out.append((name, n, first, made.hexdigest()))
                name, made, first, n = s, hashlib.sha256(), ids[0], 0
            else:
                made.update(b",")
            made.update(",".join(map(str, ids)).encode())
            n += len(ids)
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["s", "w", "first", "ends"])
    if made is not None:
        yield row()


class Trie:
    """Nodes in lists; ``below`` holds the pointers of each to its children, by the digest of their turn."""

    def __init__(self) -> None:
        self.below: list[dict[bytes, int]] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.chars: list[int] = []
        self.convs: list[int] = []
        self.first: list[int] = []
        self.ends: list[str] = []

    def node(self, parent: int, depth: int, chars: int, first: int) -> int:
        self.below.append({})
        self.parent.append(parent)
        self.depth.append(depth)
        self.chars.append(chars)
        self.convs.append(0)
        self.first.append(first)
        self.ends.append(NOTHING)
        return len(self.below) - 1

    def count(self, at: int, weight: int, first: int) -> None:
        self.convs[at] += weight
        if first < self.first[at]:
            self.first[at] = first

    def add(self, top: int, digests, chars, weight: int, first: int, ends: str) -> None:
        """A sequence whose turns up to the depth of ``top`` are those of top."""
        at = top
        self.count(at, weight, first)
        for k in range(self.depth[top], len(digests)):
            after = self.below[at].get(digests[k])
            if after is None:
                after = self.below[at][digests[k]] = self.node(at, k + 1, int(chars[k]), first)
            at = after
            self.count(at, weight, first)
        self.ends[at] = ends

    def postorder(self, tops: list[int]) -> Iterator[int]:
        """Children before their parents, without recursion."""
        stack = [(top, False) for top in tops]
        while stack:
            at, done = stack.pop()
            if done or not self.below[at]:
                yield at
            else:
                stack.append((at, True))
                stack.extend((child, False) for child in self.below[at].values())

    def sums(self, tops: list[int]) -> tuple[list[int], list[int]]:
        """Leaves and saved tokens of the subtree of each node."""
        leaves, saved = [0] * len(self.below), [0] * len(self.below)
        for at in self.postorder(tops):
            kids = self.below[at].values()
            leaves[at] = sum(leaves[k] for k in kids) or 1
            saved[at] = sum(saved[k] for k in kids) + (self.convs[at] - 1) * self.chars[at]
        return leaves, saved


def build_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    """All nodes of the subtries of a bucket; ``trunk`` is set for their tops."""
    trie, tops, about = Trie(), {}, {}
    for r in rows.itertuples(index=False):
        top = tops.get(r.key)
        if top is None:
            top = tops[r.key] = trie.node(-1, r.depth, int(r.n[r.depth - 1]), r.first)
            about[top] = (r.above, r.trunk)
        trie.add(top, r.d, r.n, r.w, r.first, r.ends)
    leaves, saved = trie.sums(list(tops.values()))
    parents = [about[i][0] if p < 0 else trie.first[p] for i, p in enumerate(trie.parent)]
    trunks = [about[i][1] if p < 0 else None for i, p in enumerate(trie.parent)]
    made = (trie.first, trie.depth, parents, trie.convs, [len(b) for b in trie.below], leaves, saved, trie.ends, trunks)
    return pd.DataFrame(dict(zip([*COLUMNS, "trunk"], made, strict=True)))


def _trunks(large: DataFrame) -> DataFrame:
    """(key, depth, last, n, convs, first, ends, above, trunk) of sequences that share their key: the turns that all of
    them have are those that the least and the greatest have."""
    made = large.groupBy("key").agg(
        F.min(F.struct("d", "n", "ends")).alias("lo"), F.max("d").alias("hi"), F.sum("w").alias("convs"), F.min("first").alias("first"),
        F.first("depth").alias("depth"), F.first("above").alias("above"), F.first("trunk").alias("trunk"),
    )
    differ = F.array_position(F.zip_with("lo.d", "hi", lambda a, b: a.eqNullSafe(b)), False)
    last = F.when(differ > 0, differ - 1).otherwise(F.size("lo.d")).cast("long")
    ends = F.when(F.size("lo.d") == last, F.col("lo.ends")).otherwise(NOTHING)
    return made.withColumn("last", last).select("key", "depth", "last", F.col("lo.n").alias("n"), "convs", "first", ends.alias("ends"), "above", "trunk")


def trie(convs: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes over ``convs`` (conv_id, turns as ``turns`` makes them, one row per conversation), from the textless
    root at depth 0: conv_id and depth, which name a node, and what is counted for it.

    Conversations without turns are members of the root only. Very long ones are rows of some 30 bytes a turn. Only the
    digest of the members that end at a node is made in order, as a stream. No conversations give no nodes.
    ``most_turns`` is how many turns of distinct sequences a subtrie may hold, unless it is a single sequence.
    """
    spark = convs.sparkSession
    prepare(spark)
    scratch = Scratch(spark, "trie")
    digests = F.transform("turns", lambda t: t["d"])
    named = short(F.array_join(F.transform("turns", lambda t: F.hex(t["d"])), ""))
    rows = scratch.write(convs.select("conv_id", digests.alias("d"), F.transform("turns", lambda t: t["n"]).alias("n"), named.alias("s")), "rows")
    ordered = rows.select("s", "conv_id").repartition("s").sortWithinPartitions("s", "conv_id")
    ends = scratch.write(ordered.mapInArrow(_ends, "s binary, w long, first long, ends string"), "ends")
    distinct = scratch.write(rows.drop("s").join(ends.drop("s"), F.col("conv_id") == F.col("first")).drop("conv_id"), "distinct")
    empty = F.size("d") == 0
    root = distinct.agg(F.sum("w").alias("convs"), F.min("first").alias("first"), F.max(F.when(empty, F.col("ends"))).alias("ends"), F.sum(F.size("d")).alias("turns")).first()
    if not root["convs"]:
        return spark.createDataFrame([], NODE)

    own = [F.col(c) for c in ("d", "n", "w", "first", "ends")]
    none = F.lit(None).cast("binary")
    pending = distinct.filter(~empty).select(F.col("d")[0].alias("key"), F.lit(1).cast("long").alias("depth"), F.lit(root["first"]).cast("long").alias("above"), none.alias("trunk"), *own)
    small, trunks = [], []
    while True:
        k = len(trunks)
        held = pending.groupBy("key").agg(F.sum(F.size("d") - F.col("depth") + 1).alias("turns"), F.count("*").alias("n"))
        large = scratch.write(held.filter((F.col("turns") > most_turns) & (F.col("n") > 1)).select("key"), f"large{k}")
        if large.isEmpty():
            small.append(pending)
            break
        small.append(pending.join(large, "key", "left_anti"))
        hot = pending.join(large, "key")
        trunks.append(scratch.write(_trunks(hot), f"trunks{k}"))
        shared = trunks[-1].select("key", "last", F.col("first").alias("least"))
        rest = hot.join(shared, "key").filter(F.size("d") > F.col("last"))
        key = short(F.concat(F.hex("key"), F.hex(F.element_at("d", (F.col("last") + 1).cast("int")))))
        rest = rest.select(key.alias("key"), (F.col("last") + 1).alias("depth"), F.col("least").alias("above"), F.col("key").alias("trunk"), *own)
        pending = scratch.write(rest, f"pending{k}")

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * (root["turns"] or 0) // most_turns))
    made = None
    for part in small:
        made = part if made is None else made.unionByName(part)
    made = made.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    out = scratch.write(made.groupBy("bucket").applyInPandas(build_bucket, f"{NODE}, trunk binary"), "nodes")
    for k in range(len(trunks) - 1, -1, -1):
        tops = out.filter(F.col("trunk").isNotNull()).groupBy("trunk").agg(F.count("*").alias("kids"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
        mine = trunks[k].join(tops.withColumnRenamed("trunk", "key"), "key")
        chain = mine.select("*", F.explode(F.sequence("depth", "last")).alias("at"))
        chain = chain.withColumn("chars", F.element_at("n", F.col("at").cast("int"))).drop("n")
        upward = Window.partitionBy("key").orderBy(F.desc("at"))  # the turns of one sequence
        is_last, is_top = F.col("at") == F.col("last"), F.col("at") == F.col("depth")
        chain = chain.select(
            F.col("first").alias("conv_id"), F.col("at").alias("depth"), F.when(is_top, F.col("above")).otherwise(F.col("first")).alias("parent_conv_id"), F.col("convs").alias("n_convs"),
            F.when(is_last, F.col("kids")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
            (F.col("saved") + (F.col("convs") - 1) * F.sum("chars").over(upward)).alias("saved_tokens"),
            F.when(is_last, F.col("ends")).otherwise(NOTHING).alias("ends_sha256"), F.when(is_top, F.col("trunk")).alias("trunk"),
        )
        out = out.unionByName(scratch.write(chain, f"chain{k}"))
    out = out.drop("trunk")
    below = out.filter(F.col("depth") == 1).agg(F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), F.lit(0)).alias("saved_tokens"))
    top = below.select(
        F.lit(root["first"]).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(root["convs"]).cast("long").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", F.lit(root["ends"] or NOTHING).alias("ends_sha256"),
    )
    return out.unionByName(top)


#: Conversations of one hundred share a start, of fewer than six turns.
SHARED, STARTS = 100, 6


def rebuilt(convs: DataFrame) -> DataFrame:
    """Every conversation c as the first h turns of conversation c - c % 100, then its own after its first h; h is
    the CRC-32 of c in decimal, modulo 6. A start that isn't there has no turns."""
    base = F.col("conv_id") - F.col("conv_id") % SHARED
    heads = convs.filter(F.col("conv_id") % SHARED == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, STARTS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % STARTS).cast("int")
    start = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), h)).otherwise(F.slice("turns", 1, 0))
    joined = convs.withColumn("base", base).join(heads, "base", "left")
    return joined.select("conv_id", F.concat(start, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


ORACLE = f"""
WITH o AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS x
           FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {crc_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM o),
c AS (SELECT h.conv_id, coalesce(b.x[1:h.h], []) || h.x[h.h + 1:] AS x
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % 100),
p AS (SELECT conv_id, unnest(range(0, len(x) + 1)) AS depth, x FROM c),
n AS (SELECT depth, x[1:depth] AS s, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (WHERE len(x) = depth), '') AS ends
      FROM p GROUP BY depth, x[1:depth]),
k AS (SELECT a.depth, a.s, count(b.depth) AS n_children FROM n a LEFT JOIN n b ON b.depth = a.depth + 1 AND b.s[1:a.depth] = a.s
      GROUP BY a.depth, a.s),
w AS (SELECT n.*, k.n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * length(s[depth].t) END AS own
      FROM n JOIN k USING (depth, s)),
z AS (SELECT d AS depth, s[1:d] AS s, sum((n_children = 0)::INT) AS n_leaves, sum(own) AS saved_tokens
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM w) GROUP BY d, s[1:d])
SELECT w.conv_id, w.depth, u.conv_id AS parent_conv_id, w.n_convs, w.n_children, CAST(z.n_leaves AS BIGINT) AS n_leaves,
       CAST(z.saved_tokens AS BIGINT) AS saved_tokens, sha256(w.ends) AS ends_sha256
FROM w JOIN z USING (depth, s) LEFT JOIN n u ON u.depth = w.depth - 1 AND u.s = w.s[1:w.depth - 1]
"""
