"""Line dedup with levelled sorted runs, in DataFrame operations only.

Documents come in batches of ascending doc_id. A run is a table of line keys with the document that owns each,
sorted by key. A new batch is merge-anti-joined with the runs; the keys that no run holds become a run of level 0.
When a level has ``fanout`` runs they are merged into one of the next level. Runs are bucketed by the key, so a
merge-anti-join moves only the batch. In the end one run holds each key once, with the smallest doc_id that has it, and
a line goes if its key's owner is another document.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.llm.runtime import Scratch, bound, fresh

#: Rows of a batch.
BATCH_ROWS = 1 << 24
#: The bytes that are white space here, and A-Z with their small letters.
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


class LineRuns:
    """Sorted runs of (h1, h2, owner), by level. h1 and h2 are two 64-bit hashes of the key."""

    def __init__(self, scratch: Scratch, fanout: int = 2):
        self.scratch, self.fanout = scratch, fanout
        self.levels: list[list[tuple[str, DataFrame]]] = []
        self.made = 0

    def _write(self, df: DataFrame) -> tuple[str, DataFrame]:
        self.made += 1
        name = f"run{self.made}"
        return name, self.scratch.write_sorted(df, name, ("h1", "h2"))

    def runs(self) -> list[DataFrame]:
        return [df for level in self.levels for _, df in level]

    def add(self, keys: DataFrame) -> None:
        """keys: distinct (h1, h2, owner) of a batch whose documents come after all before."""
        for run in self.runs():
            keys = keys.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        self._put(0, keys)

    def merged(self) -> DataFrame:
        """All runs as one, read without its buckets, so Spark may split a line that very many documents have."""
        if len(self.runs()) > 1:
            last = self._write(reduce(DataFrame.unionByName, self.runs()))
            for level in self.levels:
                for name, _ in level:
                    self.scratch.drop(name)
            self.levels = [[last]]
        return self.scratch.plain(*next(run for level in self.levels for run in level))

    def _put(self, level: int, df: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(df))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._put(level + 1, reduce(DataFrame.unionByName, [x for _, x in merged]))
            for name, _ in merged:
                self.scratch.drop(name)


def dedup_lines(docs: DataFrame, batches: int | None = None, fanout: int = 2, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: all its columns (the text with the dropped lines gone), n_lines and n_dropped,
    which replace columns of these names.

    Keys of at least ``min_chars`` code points found in two documents or more stay only in the smallest doc_id.
    A null or empty text is one empty line and stays empty. Rows that share a doc_id are one document, in which
    repeated lines stay. Rows without doc_id are one document that comes after all others. No rows give none. The cost
    of a text is linear in its length and lines.

    Batches are four, or one for ``BATCH_ROWS`` rows if that is more, unless given.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "linededup")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    print_of = F.xxhash64(text)
    base = docs.select(own.alias("d"), print_of.alias("t"), text.alias("x"))
    if batches is None:
        batches = max(4, math.ceil(docs.count() / BATCH_ROWS))
    cuts = [c for c in docs.select(own.alias("d")).approxQuantile("d", [k / batches for k in range(1, batches)], 0.01)] if batches > 1 else []
    batch = reduce(lambda a, c: a + (F.col("d") > c).cast("int"), cuts, F.lit(0))
    lines = base.select("d", "t", F.posexplode(F.split("x", "\n")).alias("pos", "line")).filter(F.octet_length("line") >= min_chars)
    lines = lines.select("d", "t", "pos", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    lines = lines.select("d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64("key", F.lit(1)).alias("h2"), batch.alias("batch"))
    lines = scratch.write(lines, "lines", partition_by="batch")
    runs = LineRuns(scratch, fanout)
    for k in range(len(cuts) + 1):
        runs.add(lines.filter(F.col("batch") == k).groupBy("h1", "h2").agg(F.min("d").alias("owner")))
    gone = lines.drop("batch").join(runs.merged().hint("merge"), ["h1", "h2"]).filter(F.col("owner") < F.col("d"))
    gone = scratch.write(gone.groupBy("d", "t").agg(F.collect_set("pos").alias("gone")), "gone")
    for made in ("lines", *(name for level in runs.levels for name, _ in level)):
        scratch.drop(made)
    mine = {c: fresh(c, docs.columns) for c in ("d", "t", "gone")}
    left = docs.withColumns({mine["d"]: own, mine["t"]: print_of})
    joined = left.join(gone.withColumnsRenamed(mine), [mine["d"], mine["t"]], "left")
    dropped, parts = F.col(mine["gone"]), F.split(text, "\n")
    # kept positions by a hash set, then the lines there: linear, however many lines go
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), dropped)
    kept = bound(parts, lambda lines: F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    made = {"n_lines": F.size(parts).cast("long"), "n_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long"), text_col: F.when(dropped.isNull(), text).otherwise(kept)}
    return joined.withColumns(made).drop(*mine.values())


def digest(deduped: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return deduped.select(id_col, "n_lines", "n_dropped", F.sha2(F.col(text_col).cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, pos, line, lower_key AS key FROM (
    SELECT doc_id, pos, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents))),
o AS (SELECT key, min(doc_id) AS owner FROM l WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT l.doc_id, l.pos, l.line, coalesce(o.owner < l.doc_id, false) AS gone FROM l LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
