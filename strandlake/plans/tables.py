"""A module as tables: what `plans.module` checks on the driver, as joins and aggregations of any size.

``references``: reference_id, ctype, file_order, seq. ``specs``: reference_id, ctype, product_name, ranges (array of
start and end, half-open, in order), required_start. ``weights``: reference_id, product_name, position, codon, count.
``rules``: reference_id, ctype and the places.

A broken rule is a row with a message; ``held`` puts such rows into the plan of a table, which then fails with the
first message when it is read. The messages are those of ``plans.module``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandlake.plans.module import MOST_SHARED
from strandlake.schema import EXON


def implemented(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """Queries with every reference group of their ctype."""
    return queries.join(groups, "ctype")


def unimplemented(queries: DataFrame, groups: DataFrame) -> DataFrame:
    """The ctypes of queries that no group has."""
    return queries.join(groups.select("ctype").distinct(), "ctype", "left_anti").select("ctype").distinct()


def groups(references: DataFrame) -> DataFrame:
    """reference_id, ctype, ref_len and the sequences of a group, in their order."""
    listed = F.array_sort(F.collect_list(F.struct("file_order", "seq")))
    return references.groupBy("reference_id", "ctype").agg(F.max(F.length("seq")).alias("ref_len"), F.transform(listed, lambda x: x["seq"]).alias("seqs"))


def exons(ranges: Column) -> Column:
    """Ranges with the coding range of each: ref_start, ref_end, cds_start, cds_end."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{EXON}>").alias("out"))

    def one(state: Column, r: Column) -> Column:
        end = state["at"] + (r["end"] - r["start"]).cast("int")
        made = F.struct(r["start"].cast("int").alias("ref_start"), r["end"].cast("int").alias("ref_end"), state["at"].alias("cds_start"), end.alias("cds_end"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(made)).alias("out"))

    return F.reduce(ranges, start, one)["out"]


def exon_problem(ranges: Column, ref_len: Column) -> Column:
    """What is wrong with a product's ranges; null if nothing is. They must be in order, not within each other, share
    two bases at most and none among three, not adjoin, lie within the reference, and have whole codons together."""
    bases = F.aggregate(ranges, F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    pairs = F.transform(F.arrays_zip(F.slice(ranges, F.lit(1), F.size(ranges) - 1).alias("a"), F.slice(ranges, F.lit(2), F.size(ranges)).alias("b")), _pair_problem)
    triples = F.arrays_zip(F.slice(ranges, F.lit(1), F.greatest(F.size(ranges) - 2, F.lit(0))).alias("a"), F.slice(ranges, F.lit(3), F.size(ranges)).alias("c"))
    return (
        F.when(ranges.isNull() | (F.size(ranges) == 0), "no exons")
        .when(bases % 3 != 0, F.concat(bases.cast("string"), F.lit(" bases are no whole codons")))
        .when(F.array_max(F.transform(ranges, lambda r: r["end"])) > ref_len, F.concat(F.lit("beyond the end of the reference ("), ref_len.cast("string"), F.lit(")")))
        .when(F.exists(pairs, lambda p: p.isNotNull()), F.filter(pairs, lambda p: p.isNotNull())[0])
        .when(F.exists(triples, lambda t: t["a"]["end"] > t["c"]["start"]), "three exons share bases")
    )


def _pair_problem(pair: Column) -> Column:
    a, b = pair["a"], pair["b"]
    return (
        F.when((b["start"] <= a["start"]) | (b["end"] <= a["end"]), "exons out of order or within each other")
        .when(a["end"] == b["start"], "adjoining exons are one")
        .when(a["end"] - b["start"] > MOST_SHARED, f"exons share more than {MOST_SHARED} bases")
    )


def products(specs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """reference_id, ctype, product_name, exons, required_start; with ``weights``, counts by position and codon, null
    for a product without any. Maps of weights grow with their table, so they are never sent through the driver."""
    out = specs.select("reference_id", "ctype", "product_name", exons(F.col("ranges")).alias("exons"), "required_start")
    if weights is None:
        return out
    counts = F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "position", "codon"), "count"))).alias("weights")
    return out.join(weights.groupBy("reference_id", "product_name").agg(counts).hint("merge"), ["reference_id", "product_name"], "left")


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of more than one row, and how many they have (n)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of rows that ``others`` hasn't."""
    return rows.select(*keys).distinct().join(others.select(*keys), keys, "left_anti")


def uneven(references: DataFrame) -> DataFrame:
    """Groups whose sequences differ in length."""
    size = F.length("seq")
    return references.groupBy("reference_id", "ctype").agg(F.min(size).alias("least"), F.max(size).alias("most")).filter("least < most")


def _listed(*names: str) -> Column:
    """Keys as they are written in a message."""
    return F.concat(F.lit("[('"), F.concat_ws("', '", *names), F.lit("')]"))


def module_problems(references: DataFrame, specs: DataFrame, weights: DataFrame | None = None, rules: DataFrame | None = None) -> DataFrame:
    """message, place: every broken rule; place orders them."""
    keys, product = ["reference_id", "ctype"], ["reference_id", "product_name"]
    name = F.concat_ws("|", *product)
    found = [
        (repeated(specs, product), F.concat(name, F.lit(" has more than one specification"))),
        (uneven(references), F.concat(F.lit("references of one group differ in length: "), _listed(*keys))),
        (without(specs, references, keys), F.concat(F.lit("coding regions without a reference: "), _listed(*keys))),
    ]
    if rules is not None:
        found.append((without(rules, references, keys), F.concat(F.lit("rewrite rules without a reference: "), _listed(*keys))))
    if weights is not None:
        found.append((without(weights, specs, product), F.concat(F.lit("weights without a coding region: "), _listed(*product))))
    lengths = references.groupBy(*keys).agg(F.min(F.length("seq")).alias("ref_len"))
    bad = specs.join(lengths, keys).withColumn("problem", exon_problem(F.col("ranges"), F.col("ref_len"))).filter("problem IS NOT NULL")
    found.append((bad, F.concat(name, F.lit(": "), F.col("problem"))))
    return reduce(DataFrame.unionByName, [rows.select(message.alias("message"), F.lit(k).alias("place")) for k, (rows, message) in enumerate(found)])


def held(rows: DataFrame, problems: DataFrame) -> DataFrame:
    """``rows``, unless there are problems (message, place): then reading them fails with the first message. Problems
    are found in the same job; nothing is collected."""
    first = problems.agg(F.min_by("message", F.struct("place", "message")).alias("m"))
    bad = first.scalar()
    return rows.filter(F.when(bad.isNotNull(), F.raise_error(bad).cast("boolean")).otherwise(True))
