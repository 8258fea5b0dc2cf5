"""A Merkle manifest of a dataset, kept as the preimages of its parents.

Every row is a leaf of the tree of its group; the roots of the groups, in order, are the leaves of one more tree. A
parent isn't stored by its digest but by its preimage, the concatenated digests of its children (64 characters each).
A leaf joins the preimages of its ancestors. From each it cuts its own 64 characters, which leaves the siblings that
prove it, or puts others in their place and hashes, which folds a leaf up to the root.

Levels are climbed eight at a time: a block holds up to 256 neighbouring nodes and the preimages of all parents above
them in the block, so a tree over 10^11 rows needs five passes, each over a 256th of the one before. Places are found
by a sort over ranges and the rows counted in each, so no task holds a group. Digests are 64 lower-case characters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch, bound

#: Levels of a block, and characters of a digest.
LEVELS, SLOT = 8, 64
PATH = "array<struct<preimage:string,slot:int>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' number, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_name(value: Column) -> Column:
    """Texts in their UTF-8 order, null before them all."""
    return F.coalesce(F.concat(F.lit("1"), value.cast("string")), F.lit("0"))


def siblings(step: Column) -> Column:
    """A preimage without the node's own slot."""
    whole, at = step["preimage"], step["slot"] * SLOT
    return F.concat(F.substring(whole, F.lit(1), at), F.substring(whole, at + SLOT + 1, F.length(whole)))


def spliced(step: Column, digest: Column) -> Column:
    """A preimage with another digest in the node's own slot."""
    whole, at = step["preimage"], step["slot"] * SLOT
    return F.concat(F.substring(whole, F.lit(1), at), digest, F.substring(whole, at + SLOT + 1, F.length(whole)))


def proof(path: Column) -> Column:
    """The siblings from the leaf to the root, left to right."""
    return F.array_join(F.transform(path, siblings), "")


def folded(path: Column, digest: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its path."""
    return F.reduce(path, digest, lambda now, step: F.sha2(spliced(step, now), 256))


def numbered(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with pos, their place from 0 in the order within ``tree``, and total, the rows of the tree. Equal rows
    are spread by where they were read."""
    keys = ["tree", *order, "spread"]
    ordered = rows.withColumn("spread", F.spark_partition_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("spread")
    placed = scratch.write(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), f"{name}_sorted")
    runs = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("tree")  # a row for each range that the tree lies in
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = runs.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
    out = placed.join(bases, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")
    out = scratch.write(out, name)
    scratch.drop(f"{name}_sorted")
    return out


def block_of(pos: Column) -> Column:
    return F.shiftright(pos, LEVELS)


def _height(total: Column) -> Column:
    """Levels until one node is left."""
    return F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0)


def _up(state: Column) -> Column:
    """One level: the preimages of neighbours, two by two, are kept and hashed; a last one stands alone."""
    now = state["now"]
    pairs = F.transform(F.sequence(F.lit(0), F.shiftright(F.size(now) - 1, 1)), lambda i: F.concat(now[2 * i], F.coalesce(F.get(now, 2 * i + 1), F.lit(""))))
    return bound(pairs, lambda p: F.struct(F.transform(p, lambda x: F.sha2(x, 256)).alias("now"), F.concat(state["preimages"], F.array(p)).alias("preimages")))


def blocks_over(nodes: DataFrame) -> DataFrame:
    """(tree, block, total, preimages by level, digest) over nodes (tree, pos, total, digest)."""
    members = F.array_sort(F.collect_list(F.struct("pos", "digest")))
    made = nodes.groupBy("tree", block_of(F.col("pos")).alias("block")).agg(members.alias("members"), F.max("total").alias("total"))
    levels = F.slice(F.array(*map(F.lit, range(LEVELS))), F.lit(1), F.least(F.lit(LEVELS), _height(F.col("total"))))
    start = F.struct(F.transform("members", lambda m: m["digest"]).alias("now"), F.array().cast("array<array<string>>").alias("preimages"))
    made = made.withColumn("top", F.reduce(levels, start, lambda state, _: _up(state)))
    left = F.shiftright(F.col("total") + (1 << LEVELS) - 1, LEVELS)
    return made.select("tree", "block", left.alias("total"), F.col("top.preimages").alias("preimages"), F.col("top.now")[0].alias("digest"))


def with_path(nodes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Nodes (tree, pos, ..) join the preimages of their ancestors: those in their block, then those above it. What
    else a block has (subroot, root) is joined, too."""
    slot = F.col("pos").bitwiseAND((1 << LEVELS) - 1).cast("int")
    shifted = lambda j: F.call_function("shiftright", slot, j)
    own = F.transform("over", lambda p, j: F.struct(F.get(p, shifted(j + 1)).alias("preimage"), shifted(j).bitwiseAND(1).alias("slot")))
    more = [c for c in blocks.columns if c not in ("tree", "block", "total", "preimages", "digest", "path")]
    above = blocks.select("tree", "block", F.col("preimages").alias("over"), F.col("path").alias("above"), *more)
    joined = nodes.withColumn("block", block_of(F.col("pos"))).join(above, ["tree", "block"])
    return joined.select(*nodes.columns, F.concat(own, F.col("above")).cast(PATH).alias("path"), *more)


@dataclass
class Manifest:
    """``leaves`` (tree, pos, total, digest and what was carried), the blocks of each stage over them, and the same
    for the tree of roots."""

    leaves: DataFrame
    stages: list[DataFrame]
    roots: DataFrame  # (tree, pos, total, digest, name): the groups' roots in order
    root_stages: list[DataFrame]

    def root(self) -> str:
        """The digest of the whole."""
        return (self.root_stages[-1] if self.root_stages else self.roots).select("digest").first()["digest"]

    def preimages(self) -> DataFrame:
        """(tree, level from 1, node, preimage) of every parent of the groups' trees."""
        out = None
        for k, blocks in enumerate(self.stages):
            levels = blocks.select("tree", "block", F.posexplode("preimages").alias("j", "row"))
            rows = levels.select("tree", "j", "block", F.posexplode("row").alias("i", "preimage"))
            node = F.call_function("shiftleft", F.col("block"), F.lit(LEVELS - 1) - F.col("j")) + F.col("i")
            rows = rows.select("tree", (F.col("j") + k * LEVELS + 1).alias("level"), node.alias("node"), "preimage")
            out = rows if out is None else out.unionByName(rows)
        if out is None:
            return self.leaves.select("tree", F.lit(1).alias("level"), F.col("pos").alias("node"), F.col("digest").alias("preimage")).limit(0)
        return out

    def paths(self) -> DataFrame:
        """The leaves with path (preimages of their ancestors and their slot in each), subroot and root."""
        root, top = F.lit(self.root()).alias("root"), F.array().cast(PATH).alias("path")
        if not self.root_stages:  # one group: its root is the root
            above = self.roots.select("name", F.col("digest").alias("subroot"), top, root)
        else:
            now = self.root_stages[-1].select("*", top, root)
            for k in range(len(self.root_stages) - 2, -1, -1):
                nodes = self.root_stages[k].withColumnRenamed("block", "pos")
                now = with_path(nodes, now).withColumnRenamed("pos", "block")
            above = with_path(self.roots, now).select("name", F.col("digest").alias("subroot"), "path", "root")
        above = above.withColumnRenamed("name", "tree")
        if not self.stages:  # groups of one row: a leaf is its group's root
            return self.leaves.join(above, "tree")
        now = self.stages[-1].join(above, "tree")
        for k in range(len(self.stages) - 2, -1, -1):
            nodes = self.stages[k].withColumnRenamed("block", "pos")
            now = with_path(nodes, now).withColumnRenamed("pos", "block")
        return with_path(self.leaves, now)


def _climb(nodes: DataFrame, scratch: Scratch, name: str) -> list[DataFrame]:
    """Blocks of each stage, up to one node for each tree."""
    stages: list[DataFrame] = []
    most = nodes.agg(F.max("total").alias("n")).first()["n"] or 0
    while most > 1:
        stages.append(scratch.write(blocks_over(nodes), f"{name}{len(stages)}"))
        nodes = stages[-1].select("tree", F.col("block").alias("pos"), "total", "digest")
        most = -(-most >> LEVELS)
    return stages


def build(docs: DataFrame, fields: list[str], by: str, id_col: str, carry: dict[str, Column] | None = None) -> Manifest | None:
    """The manifest of ``docs``: a tree for each value of ``by`` (null is one of them, before all others), in which
    rows ascend by ``id_col`` (null first; rows that share an id by their digests). A leaf is the digest of ``fields``,
    where null is told from the empty text. ``carry`` are further columns of the leaves.

    Repeated rows are leaves of their own. Texts are hashed whole, and only digests are kept. No rows have no
    manifest: None.
    """
    scratch = Scratch(docs.sparkSession, "manifest")
    leaf = leaf_digest(*[F.col(f) for f in fields]).alias("digest")
    made = docs.select(group_name(F.col(by)).alias("tree"), F.col(id_col).alias("id"), leaf, *[c.alias(k) for k, c in (carry or {}).items()])
    leaves = numbered(scratch.write(made, "leaves"), ["id", "digest"], scratch, "placed")
    scratch.drop("leaves")
    stages = _climb(leaves, scratch, "stage")
    tops = (stages[-1] if stages else leaves).select(F.lit("").alias("tree"), "digest", F.col("tree").alias("name"))
    roots = numbered(tops, ["name"], scratch, "roots")
    if roots.isEmpty():
        return None
    return Manifest(leaves, stages, roots, _climb(roots, scratch, "root_stage"))


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(docs: DataFrame, tampered: Column, changed: dict[str, Column], fields: list[str], by: str, id_col: str = "doc_id") -> DataFrame:
    """Per row: its leaf, subroot, root, the digest of its proof, the root folded from what is claimed, and whether
    they agree. Rows where ``tampered`` holds claim ``changed`` values (by field), all others their own. Nulls in
    ``tampered`` count as false. Repeated rows give a row each; no rows give none."""
    own = leaf_digest(*[F.col(f) for f in fields])
    other = leaf_digest(*[changed.get(f, F.col(f)) for f in fields])
    made = build(docs, fields, by, id_col, {"claimed": F.when(tampered, other).otherwise(own)})
    if made is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    out = made.paths().withColumn("folded_root", folded(F.col("path"), F.col("claimed")))
    return out.select(F.col("id").cast("long").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def crc_sql(text: str) -> str:
    """DuckDB SQL for the unsigned CRC-32 of a text of ASCII characters."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), lambda a, b: {step}), 4294967295)"


def _field_sql(value: str) -> str:
    return f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || {value}, '-')"


_LEAF = " || ".join(map(_field_sql, ("doc_id", "source", "lang")))
ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS tree,
         sha256({_LEAF} || {_field_sql("n_chars")} || {_field_sql("text")}) AS leaf,
         CASE WHEN {crc_sql("CAST(doc_id AS VARCHAR)")} % 7 = 0
              THEN sha256({_LEAF} || {_field_sql("(n_chars + 1)")} || {_field_sql("text")}) END AS other
  FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
t AS (
  SELECT 0 AS level, tree, pos, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM l
  UNION ALL
  SELECT any_value(level) + 1, tree, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM t WHERE n > 1 GROUP BY tree, pos // 2),
s AS (SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos FROM t WHERE n = 1),
r AS (
  SELECT 0 AS level, pos, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT any_value(level) + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 1) // 2
  FROM r WHERE n > 1 GROUP BY pos // 2),
path AS (
  SELECT l.doc_id, l.tree, l.pos, t.level AS step, (l.pos >> t.level) & 1 AS slot, o.h AS sibling
  FROM l JOIN (SELECT DISTINCT tree, level FROM t WHERE n > 1) t USING (tree)
  LEFT JOIN t o ON o.tree = l.tree AND o.level = t.level AND o.pos = xor(l.pos >> t.level, 1::BIGINT)
  UNION ALL
  SELECT l.doc_id, l.tree, l.pos, s.height + r.level, (s.pos >> r.level) & 1, o.h
  FROM l JOIN s USING (tree) CROSS JOIN (SELECT DISTINCT level FROM r WHERE n > 1) r
  LEFT JOIN r o ON o.level = r.level AND o.pos = xor(s.pos >> r.level, 1::BIGINT)),
paths AS (SELECT tree, pos, list(struct_pack(slot := slot, sibling := coalesce(sibling, '')) ORDER BY step) AS path,
                 sha256(string_agg(coalesce(sibling, ''), '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY tree, pos),
f AS (
  SELECT tree, l.pos, 0 AS step, coalesce(other, leaf) AS h FROM l
  UNION ALL
  SELECT f.tree, f.pos, f.step + 1, CASE WHEN path[f.step + 1].slot = 1
         THEN sha256(path[f.step + 1].sibling || h) ELSE sha256(h || path[f.step + 1].sibling) END
  FROM f JOIN paths USING (tree, pos) WHERE f.step < len(path))
SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM r WHERE n = 1) AS root,
       coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = (SELECT h FROM r WHERE n = 1) AS verified
FROM l JOIN s USING (tree) LEFT JOIN paths p ON p.tree = l.tree AND p.pos = l.pos
JOIN f ON f.tree = l.tree AND f.pos = l.pos AND f.step = coalesce(len(p.path), 0)
"""
