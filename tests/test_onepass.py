"""The six tables from one pass are those of six."""

import pytest

from strandlake.plans.annotate import annotate, prepare
from strandlake.plans.module import Module
from strandlake.plans.onepass import read_together, table_lines, write_together
from strandlake.schema import TABLES
from strandlake.sources.config import ModuleConfig, Penalties, Reference, Spec

REF = "ATGAAACCCGGGTTTTAA"
SPECS = (Spec("R", "T", "P", ((0, 18),), "ATG"), Spec("R", "T", "Q", ((3, 9),), None), Spec("S", "T", "late", ((12, 18),), None))
QUERIES = {
    "same": REF,
    "stop": "ATGTAACCCGGGTTTTAA",
    "part": "AAACCCGGGTTTT",
    "inserted": "ATGAAACCCCATGGGTTTTAA",
    "deleted": "ATGAAAGGGTTTTAA",
    "head": "ATGAAACC",
    "gone": "ATGGGGTTTTAA",
    "none": "NNNNNN",
}


def module(pad=True):
    config = ModuleConfig("m", "1", "-", "-", {"default": Penalties(5, 4, 4, 1)}, one_pass=True, right_pad_aa=pad, right_pad_cds=pad, right_pad_gen=pad)
    # U has references and no product: its genomes are written all the same
    refs = (Reference("R", "T", 0, REF), Reference("S", "T", 1, REF[:9] + "C" + REF[10:]), Reference("N", "U", 2, REF))
    return Module(config, refs, SPECS, {}, {})


def queries(spark, rows):
    return prepare(spark.createDataFrame(rows, "id string, ctype string, seq string"))


@pytest.mark.parametrize("pad", [True, False])
def test_same_tables(spark, tmp_path, pad):
    rows = [(k, c, s) for k, s in QUERIES.items() for c in ("T", "U", "V")] + [("same", "T", REF)] * 2
    q, m = queries(spark, rows), module(pad)
    folder = str(tmp_path / "tables")
    write_together(table_lines(q, m), folder)
    got, done = read_together(spark, folder), annotate(q, m)
    assert set(got) == set(TABLES)
    for t, df in done.tables().items():
        want = sorted(map(repr, df.collect()))
        assert sorted(map(repr, got[t].select(*df.columns).collect())) == want
        assert want, t
    assert {r.kind for r in got["seq"].collect()} == {"data", "deleted"}
    done.kept.unpersist()


def test_aligned_once_and_nothing_kept(spark):
    lines = table_lines(queries(spark, [("same", "T", REF)]), module())
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "InMemoryTableScan" not in plan
    # nor are rows gathered by reference
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2


def test_nothing_to_write(spark, tmp_path):
    for k, rows in enumerate(([], [("none", "T", "NNNN")], [("other", "V", REF)])):
        folder = str(tmp_path / str(k))
        write_together(table_lines(queries(spark, rows), module()), folder)
        assert all(df.count() == 0 and df.columns[:3] == [c.split()[0] for c in TABLES[t].split(", ")][:3] for t, df in read_together(spark, folder).items())
