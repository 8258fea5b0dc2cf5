import random

import pytest

from strandlake.plans import module as on_driver
from strandlake.plans import tables
from strandlake.schema import AnnotationError
from strandlake.sources.config import ModuleConfig, Penalties, Reference, Rule, Spec, load_weights
from strandlake.sources.sections import carried, read_weights, text_lines

CONFIG = ModuleConfig("m", "1", "-", "-", {"default": Penalties(1, 1, 2, 1)})
REFS = [Reference("R", "T", 0, "A" * 60), Reference("R", "T", 1, "C" * 60), Reference("S", "U", 2, "G" * 30)]
SPECS = [Spec("R", "T", "P", ((3, 12), (11, 20)), "ATG"), Spec("R", "T", "Q", ((0, 60),), None), Spec("S", "U", "P", ((1, 4), (6, 9)), None)]
WEIGHTS = {("R", "P"): {(1, "ATG"): 4, (2, "CCC"): 1}}
RULES = {("R", "T"): [Rule(1, 2, 3, 4)]}


def as_tables(spark, refs, specs, weights, rules):
    return (
        spark.createDataFrame([(r.reference_id, r.ctype, r.file_order, r.seq) for r in refs], "reference_id string, ctype string, file_order int, seq string"),
        spark.createDataFrame([(s.reference_id, s.ctype, s.product_name, [{"start": a, "end": b} for a, b in s.ranges], s.required_start) for s in specs], "reference_id string, ctype string, product_name string, ranges array<struct<start:int,end:int>>, required_start string"),
        spark.createDataFrame([(*k, p, c, n) for k, own in weights.items() for (p, c), n in own.items()], "reference_id string, product_name string, position int, codon string, count long"),
        spark.createDataFrame([(*k, r.from_start) for k, own in rules.items() for r in own], "reference_id string, ctype string, at int"),
    )


BROKEN = {
    "uneven": ([*REFS, Reference("R", "T", 3, "A" * 59)], SPECS, WEIGHTS, RULES),
    "no reference": (REFS, [*SPECS, Spec("X", "T", "P", ((0, 3),), None)], WEIGHTS, RULES),
    "no region": (REFS, SPECS, WEIGHTS | {("S", "Q"): {(1, "AAA"): 1}}, RULES),
    "no rule": (REFS, SPECS, WEIGHTS, {("R", "U"): [Rule(1, 2, 3, 4)]}),
} | {
    str(ranges): (REFS, [Spec("S", "U", "P", ranges, None)], {}, {})
    for ranges in (((0, 4),), ((0, 33),), ((5, 8), (1, 4)), ((1, 9), (3, 7), (10, 13)), ((0, 3), (3, 6)), ((0, 7), (4, 9), (11, 12)), ((0, 4), (2, 5), (3, 8)))
}


@pytest.mark.parametrize("case", sorted(BROKEN))
def test_the_same_messages_as_on_the_driver(spark, case):
    refs, specs, weights, rules = BROKEN[case]
    with pytest.raises(AnnotationError) as wanted:
        on_driver.Module(CONFIG, tuple(refs), tuple(specs), weights, rules)
    r, s, w, u = as_tables(spark, refs, specs, weights, rules)
    with pytest.raises(Exception) as got:
        tables.held(s, tables.module_problems(r, s, w, u)).collect()
    assert str(wanted.value) in str(got.value)


def test_a_sound_module_passes(spark):
    module = on_driver.Module(CONFIG, tuple(REFS), tuple(SPECS), WEIGHTS, RULES)
    r, s, w, u = as_tables(spark, REFS, SPECS, WEIGHTS, RULES)
    problems = tables.module_problems(r, s, w, u)
    assert problems.collect() == []
    key = lambda x: tuple(map(str, x))
    got = tables.held(tables.products(s), problems)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, module.product_table(spark).collect()), key=key)
    assert sorted(tuple(x)[:3] for x in tables.groups(r).collect()) == sorted(map(tuple, module.group_table(spark).collect()))
    assert {(x.reference_id, x.ctype): x.seqs for x in tables.groups(r).collect()} == module.groups()
    assert {x.product_name: x.weights for x in tables.products(s, w).filter("reference_id = 'R'").collect()} == {"P": {"1:ATG": 4, "2:CCC": 1}, "Q": None}


def test_repeated_specifications(spark):
    r, s, _, _ = as_tables(spark, REFS, [*SPECS, SPECS[0]], {}, {})
    with pytest.raises(Exception, match="more than one specification"):
        tables.held(s, tables.module_problems(r, s)).collect()


def written(tmp_path, lines):
    path = tmp_path / "weights.tsv"
    path.write_text("\n".join(lines))
    return str(path)


def test_weights_in_small_blocks(spark, tmp_path):
    """Blocks of 300 bytes: sections of many blocks, and many sections in one, give what the driver's reader gives."""
    rng = random.Random(2)
    lines, seen = ["", ""], set()
    for k in range(40):
        lines.append(f"#R{k} | P{k % 3}|more")
        for i in range(rng.choice([1, 2, 150])):
            lines.append(f"{i + 1} {rng.choice(['AUG', 'ccc', 'NNN'])}\t{rng.randint(0, 9)}")
        seen.add(k)
    path = written(tmp_path, lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got: dict = {}
        for r in read_weights(spark, path).collect():
            got.setdefault((r.reference_id, r.product_name), {})[r.position, r.codon] = r["count"]
        assert text_lines(spark, path).select("block").distinct().count() > 30
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == load_weights(path)


@pytest.mark.parametrize("lines", [["1 ATG 3"], ["#a|b", "#c|d", "1 ATG 3"], ["#a|b", "1 ATG 3", "#a|b", "2 ATG 3"], ["#a|b", "1 ATG 3", "1 AUG 2"], ["#a|b", "0 ATG 3"], ["#a|b", "1 ATGA 3"], ["#a|b", "1 ATG"], ["#ab", "1 ATG 3"], ["#a|", "1 ATG 3"], ["#a|b", "1 ATG -3"], ["#a|b"]])
def test_broken_weights_fail_in_both_readers(spark, tmp_path, lines):
    path = written(tmp_path, lines)
    with pytest.raises(AnnotationError) as wanted:
        load_weights(path)
    with pytest.raises(Exception) as got:
        read_weights(spark, path).collect()
        raise AssertionError("nothing was wrong") if lines != ["#a|b"] else AnnotationError("empty section")
    assert str(wanted.value).split(":")[0] in str(got.value)


def test_carried_over_blocks_without_a_header(spark):
    rows = [("f", b, i, "h" if (b, i) in ((0, 2), (4, 1)) else None) for b in range(6) for i in range(3)] + [("g", 0, 0, None)]
    df = spark.createDataFrame([(f, b, i, h and f"{h}{b}") for f, b, i, h in rows], "file string, block int, at int, h string").repartition(4)
    from pyspark.sql import functions as F

    got = {(r.file, r.block, r["at"]): r.section for r in carried(df, F.col("h")).collect()}
    want, now = {}, None
    for f, b, i, h in rows:
        now = None if f == "g" else f"h{b}" if h else now
        want[f, b, i] = now
    assert got == want


def test_products_and_weights_are_not_sent_through_the_driver(spark):
    specs = spark.createDataFrame([("R", "T", "p", [(0, 3)], None)], "reference_id string, ctype string, product_name string, ranges array<struct<start:int,end:int>>, required_start string")
    weights = spark.createDataFrame([("R", "p", 1, "ATG", 5)], "reference_id string, product_name string, position int, codon string, count int")
    rows = tables.products(specs, weights)
    assert rows.select("weights").collect()[0][0] == {"1:ATG": 5}
    assert "BroadcastExchange" not in rows._jdf.queryExecution().executedPlan().toString()
