"""Command line: annotate a file of queries into the six tables."""

from __future__ import annotations

import argparse
import logging
import os
import secrets
import sys

from pyspark.sql import Observation, SparkSession

from strandlake.operators.classify import KmerIndex, classifier
from strandlake.plans.annotate import annotate, prepare, unclassified, unimplemented_by_module
from strandlake.plans.module import ctypes_elsewhere, load
from strandlake.plans.onepass import table_lines, write_together
from strandlake.sources.queries import read_queries
from strandlake.sources.tables import GENOME_TABLES, PRODUCT_TABLES, check_paths, write_table

log = logging.getLogger("strandlake")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandlake", description=__doc__)
    p.add_argument("data_file")
    p.add_argument("outputs", nargs="*", help="none, 3 (seq ins del), 4 (and the genome sequences) or 6 paths")
    p.add_argument("--output-prefix", help="prefix of the six outputs; a folder gets a random name in it")
    p.add_argument("--modules-dir", default=os.environ.get("STRANDLAKE_MODULES", "."))
    p.add_argument("--module", default="flu")
    p.add_argument("--threads", type=int, help="cores of a local session")
    p.add_argument("--assume-default-ctype", help="the type of sequences without one; else the module's references tell it")
    p.add_argument("--no-classifier", action="store_true", help="a sequence without a type is an error")
    p.add_argument("--format", default="tsv")
    p.add_argument("--one-pass", action="store_true", help="all six as tab-delimited text in the folder {prefix}tables, from one pass that keeps nothing in memory")
    p.add_argument("--verbose", action="store_true")
    return p


def output_paths(args: argparse.Namespace) -> dict[str, str]:
    every = (*PRODUCT_TABLES, *GENOME_TABLES)
    if args.one_pass and (args.outputs or args.format != "tsv"):
        raise SystemExit("one pass writes the six tables as tab-delimited text under a prefix")
    if args.outputs and args.output_prefix:
        raise SystemExit("give outputs or a prefix, not both")
    if args.outputs:
        if len(args.outputs) not in (3, 4, 6):
            raise SystemExit("give 3, 4 or 6 outputs")
        return dict(zip(every, args.outputs, strict=False))
    prefix = args.output_prefix or secrets.token_hex(16) + "_"
    if prefix.endswith("/") or os.path.isdir(prefix):
        prefix = os.path.join(prefix, secrets.token_hex(16) + "_")
    if args.one_pass:
        return {"tables": f"{prefix}tables"}
    return {t: f"{prefix}{t}" for t in every}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(format="%(asctime)s %(message)s", level=logging.INFO if args.verbose else logging.WARNING)
    paths = output_paths(args)
    check_paths(args.data_file, list(paths.values()))
    builder = SparkSession.builder.appName("strandlake")
    spark = (builder.master(f"local[{args.threads}]") if args.threads else builder).getOrCreate()
    module = load(args.modules_dir, args.module)
    if not module.have_weights:
        log.warning("module %s has no codon weights", module.config.name)
    raw = read_queries(spark, args.data_file)
    tell = None if args.no_classifier or args.assume_default_ctype else classifier(KmerIndex.of(module.references))
    prepared, aligned = Observation("prepared"), Observation("aligned")
    queries = prepare(raw, args.assume_default_ctype, tell, prepared)
    if args.one_pass:
        write_together(table_lines(queries, module, aligned), paths["tables"])
        done = annotate(queries, module, keep=False)
    else:
        done = annotate(queries, module, seen=aligned)
        tables = done.tables()
        for t, path in paths.items():
            write_table(tables[t], t, path, args.format)
    counts = prepared.get | aligned.get  # of the first table's job; no job of their own
    log.info("%(prepared)d sequences, %(without_bases)d without bases; %(pairs)d alignments tried, %(unaligned)d without a score", counts)
    for r in unimplemented_by_module(done.unimplemented, ctypes_elsewhere(spark, args.modules_dir, module.config.name)).toLocalIterator():
        log.warning("not implemented here%s: %s", f", but in module {r['module']}" if r["module"] else "", ", ".join(r["ctypes"]))
    if args.verbose and tell is not None:
        for r in unclassified(raw, tell).toLocalIterator():
            log.info("%s: %s%s", r["status"], r["id"], f", possible types: {', '.join(r['taxa'])}" if r["taxa"] else "")
    if args.verbose:
        for r in done.unaligned.toLocalIterator():
            log.info("no alignment: %s to %s", r["query_id"], r["reference_id"])
    done.kept.unpersist()
    return 0


if __name__ == "__main__":
    sys.exit(main())
