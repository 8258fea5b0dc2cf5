"""The annotation of a table of queries as one plan.

Query rows are joined to the groups of their ctype and to the products of each group; everything nested stays in
arrays of the row, so after these joins with small tables no shuffle follows. Alignment and the two sequential
steps run in Arrow batches; the rest are column expressions. Alignment costs far more than moving a row, so rows are
dealt out evenly before it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from strandlake.functions.iupac import reverse_complement, sanitize_id, sanitize_seq
from strandlake.operators.align import align_rows
from strandlake.operators.ends import chew_offset, repaired, stop_extension
from strandlake.operators.frames import fix_frames_udf, rewrite_udf
from strandlake.operators.materialize import genome_rows, materialize_products, product_rows, with_stop_extension
from strandlake.operators.states import condensed, extended, has_required_start, in_exons, needs_frame_fix, states_of, written_cigar
from strandlake.plans.module import Module, sent
from strandlake.plans.tables import implemented, unimplemented

#: A classifier adds ``classified`` (a ctype), ``strand`` (+ or -) and ``status`` ("classified" or a reason) to rows.
#: ``operators.classify.classifier`` makes one from references.
Classifier = Callable[[DataFrame], DataFrame]


def unclassified(raw: DataFrame, classifier: Classifier) -> DataFrame:
    """id, status and what else the classifier says of rows without a ctype that it can't tell."""
    told = classifier(raw.select("id", "ctype", "seq").filter(F.col("ctype").isNull()))
    return told.filter(F.col("status") != "classified").drop("ctype", "seq", "classified", "strand")


def prepare(raw: DataFrame, default_ctype: str | None = None, classifier: Classifier | None = None, seen: Observation | None = None) -> DataFrame:
    """query_id, nt, ctype of raw rows id, ctype, seq. A row without a ctype gets the classifier's (and is turned if it
    is of the minus strand; rows it can't tell are dropped), else the default; without either it is an error. Rows
    without nucleotides are dropped. ``seen`` gets ``prepared`` and, of these, ``without_bases`` from the job that reads
    the result."""
    rows = raw.select("id", "ctype", "seq")
    if classifier is not None:
        known = rows.filter(F.col("ctype").isNotNull())
        told = classifier(rows.filter(F.col("ctype").isNull())).filter(F.col("status") == "classified")
        turned = F.when(F.col("strand") == "-", reverse_complement(F.upper("seq"))).otherwise(F.col("seq"))
        rows = known.unionByName(told.select("id", F.col("classified").alias("ctype"), turned.alias("seq")))
    missing = F.raise_error(F.concat(F.lit("no ctype: "), F.col("id"))).cast("string") if default_ctype is None else F.lit(default_ctype)
    ctype = F.when(F.col("ctype").isNull(), missing).otherwise(F.col("ctype"))
    made = rows.select(sanitize_id(F.col("id")).alias("query_id"), sanitize_seq(F.col("seq")).alias("nt"), ctype.alias("ctype"))
    if seen is not None:
        made = made.observe(seen, F.count("*").alias("prepared"), F.count_if(F.length("nt") == 0).alias("without_bases"))
    return made.filter(F.length("nt") > 0)


@dataclass
class Annotation:
    """Tables of a run; ``aligned`` is kept for the others and can be unpersisted after them."""

    products: DataFrame
    genomes: DataFrame
    unimplemented: DataFrame
    unaligned: DataFrame
    module: Module
    kept: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        c = self.module.config
        return product_rows(self.products, c.right_pad_aa, c.right_pad_cds) | genome_rows(self.genomes, c.right_pad_gen)


def aligned_states(queries: DataFrame, module: Module) -> DataFrame:
    """Queries with every group of their ctype: the alignment, its states after the rules on ends and deletions, and
    the end of a stop extension. Groups that don't align have a null score."""
    spark, c = queries.sparkSession, module.config
    groups = module.groups()
    rows = implemented(queries, sent(module.group_table(spark), len(groups)))
    least = spark.sparkContext.defaultParallelism * 4
    rows = rows.repartition(max(least, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = rows.withColumn("chewed", chew_offset(F.col("nt"), F.col("ref_len"), F.lit(c.chew_to_start)))
    rows = align_rows(rows, {k: (seqs, c.penalties(k[1]), c.one_pass) for k, seqs in groups.items()})
    ends = repaired(*(F.col(x) for x in ("q_start", "q_end", "r_start", "r_end")), F.length("nt"), F.col("ref_len"), F.lit(c.repairable_end_limit))
    states = extended(states_of(F.col("cigar"), F.col("q_start"), F.col("r_start")), ends["left"], ends["right"])
    # apart, as names within lambda functions could mean columns of the same projection
    rows = rows.withColumn("states", F.when(F.col("score").isNotNull(), states))
    rows = rows.withColumns({k: ends[k] for k in ("q_start", "q_end", "r_start", "r_end")})
    rows = rows.withColumn("stop_end", stop_extension(*(F.col(x) for x in ("nt", "q_start", "q_end", "r_end", "ref_len")), F.lit(c.try_stop_extension)))
    if module.rules:
        with_rules = F.concat_ws("|", "reference_id", "ctype").isin(["|".join(k) for k in module.rules]) & F.exists("states", lambda s: s["op"] == "D")
        changed = rewrite_udf(module.rules)(F.when(with_rules, F.col("states")), "reference_id", "ctype")
        rows = rows.withColumn("states", F.coalesce(changed, "states"))
    more = F.when(F.col("stop_end").isNotNull(), F.concat((F.col("stop_end") - F.col("q_end")).cast("string"), F.lit("I"))).otherwise(F.lit(""))
    return rows.withColumn("cigar", F.when(F.col("score").isNotNull(), F.regexp_replace(written_cigar(F.col("states"), F.coalesce("stop_end", "q_end")), "[0-9]+S$", ""))).withColumn("cigar", F.concat("cigar", more))


def products_of(aligned: DataFrame, module: Module, genomes: bool = False) -> DataFrame:
    """Aligned rows with every product of their group, materialised; their states are then under ``genome``. With
    ``genomes`` each row comes once more, without a product."""
    spark = aligned.sparkSession
    products = module.product_table(spark)
    if genomes:
        whole = [F.lit(None).cast(f.dataType).alias(f.name) if f.name in ("product_name", "required_start") else F.array().cast(f.dataType).alias(f.name) if f.name == "exons" else F.col(f.name) for f in products.schema]
        products = products.unionByName(module.group_table(spark).select(*whole))
    rows = aligned.join(sent(products, len(module.specs) + len(module.references)), ["reference_id", "ctype"])
    rows = rows.withColumnRenamed("states", "genome").withColumn("states", in_exons(F.col("genome"), F.col("exons")))
    last = F.try_element_at("exons", F.lit(-1))
    cds_len = last["cds_end"]
    size = F.aggregate(F.filter("states", lambda s: s["op"] != "I"), F.lit(0), lambda a, s: a + s["c_end"] - s["c_start"])
    solid = F.filter("states", lambda s: s["op"] != "I")
    rows = rows.withColumns({"cds_len": cds_len, "lpad": F.coalesce(F.try_element_at(solid, F.lit(1))["c_start"], F.lit(0)), "aligned_len": size})
    rows = rows.withColumn("rpad", F.col("cds_len") - F.col("lpad") - F.col("aligned_len"))
    fixed = fix_frames_udf(module.shapes())(F.when(needs_frame_fix(F.col("states")), F.col("states")), "nt", "reference_id", "ctype", "product_name")
    rows = rows.withColumn("states", condensed(F.coalesce(fixed, "states")))
    rows = rows.filter((F.size("states") == 0) | has_required_start(F.col("states"), F.col("nt"), F.col("required_start")))
    ends_last = last["ref_end"] == F.col("ref_len")
    rows = rows.withColumn("states", with_stop_extension(F.col("states"), ends_last, F.col("q_end"), F.col("stop_end"), F.col("cds_len")))
    return materialize_products(rows)


def annotate(queries: DataFrame, module: Module, keep: bool = True, seen: Observation | None = None) -> Annotation:
    """queries: query_id, nt, ctype. With ``keep`` the aligned rows are persisted (memory and disk), since several
    tables follow from them and alignment is the costly step; without, for a single table, they are not. ``seen`` gets
    ``pairs`` of queries and reference groups, and how many of them are ``unaligned``, from the first table's job."""
    spark = queries.sparkSession
    aligned = aligned_states(queries, module)
    if seen is not None:
        aligned = aligned.observe(seen, F.count("*").alias("pairs"), F.count_if(F.col("score").isNull()).alias("unaligned"))
    if keep:
        aligned = aligned.persist(StorageLevel.MEMORY_AND_DISK)
    good = aligned.filter(F.col("score").isNotNull())
    return Annotation(
        products_of(good, module),
        good,
        unimplemented(queries, module.group_table(spark)),
        aligned.filter(F.col("score").isNull()).select("query_id", "ctype", "reference_id"),
        module,
        aligned,
    )


def unimplemented_by_module(unimplemented: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """module, ctypes: which other module has each ctype that isn't implemented; the first in the file wins, and those
    that none has are under a null module."""
    first = elsewhere.groupBy("ctype").agg(F.min_by("module", "module_order").alias("module"))
    return unimplemented.join(first, "ctype", "left").groupBy("module").agg(F.array_sort(F.collect_set("ctype")).alias("ctypes"))
