import random
import time
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from strandlake.llm.linededup import LineRuns, dedup_lines
from strandlake.llm.runtime import Scratch

SPACE = " \t\n\x0b\f\r"


def brute(rows):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    holders = defaultdict(set)
    for d, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(d)
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or len(holders[key(x)]) < 2 or min(holders[key(x)]) == d]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (6, 3)])
def test_against_brute_force(spark, batches, fanout):
    rng = random.Random(batches)
    lines = ["A shared line of text", "  a SHARED line of text\t", "Élan vital éternel", "élan vital éternel", "short", "", "another longer line", "x" * 10, "y" * 9, "only once %d"]
    rows = [(i, "\n".join(rng.choice(lines).replace("%d", str(i)) for _ in range(rng.randint(0, 8)))) for i in range(0, 90, 3)]
    rows += [(500, None), (501, ""), (502, "A shared line of text\nA shared line of text")]
    df = spark.createDataFrame([(d, t, 7, "z") for d, t in rows], "doc_id long, text string, h1 int, owner string").repartition(3)
    got = dedup_lines(df, batches, fanout)
    assert sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == brute(rows)
    assert got.columns[:4] == ["doc_id", "text", "h1", "owner"]


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    long = "a line that is long enough"
    rows = [(1, long), (1, long), (None, long), (None, long + "\nother text of its own"), (2, long + "\n" + long)]
    got = sorted(((r.doc_id or 0, r.text, r.n_dropped) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()))
    assert got == [(0, "", 1), (0, "other text of its own", 1), (1, long, 0), (1, long, 0), (2, "", 2)]
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_columns_of_the_user_stay(spark):
    rows = [(1, "a line that is long enough", 1, 2, 3, 4), (2, "a line that is long enough\nx", 5, 6, 7, 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __d int, d int, t int, gone int")
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(*rows[0], 1, 0), (2, "x", 5, 6, 7, 8, 2, 1)]


def test_many_lines_in_one_document(spark):
    lines = [f"line number {i} of a long text" for i in range(80_000)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join([*lines, "its own last line"]))], "doc_id long, text string")
    start = time.perf_counter()
    got = {r.doc_id: (len(r.text), r.n_lines, r.n_dropped) for r in dedup_lines(df).collect()}
    assert got == {1: (len("\n".join(lines)), 80_000, 0), 2: (17, 80_001, 80_000)}
    assert time.perf_counter() - start < 60


def test_a_batch_moves_no_run(spark):
    """The anti-join with a run shuffles the batch only."""
    scratch = Scratch(spark, "test")
    runs = LineRuns(scratch)
    runs.add(spark.range(100).select(F.col("id").alias("h1"), F.col("id").alias("h2"), F.col("id").alias("owner")))
    keys = spark.range(150).groupBy(F.col("id").alias("h1"), F.col("id").alias("h2")).agg(F.lit(1).alias("owner"))
    left = keys.join(runs.runs()[0].select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    assert left.count() == 50
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1, plan
