"""Functions for SQL: expressions as SQL functions, alignment and annotation as Python ones."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandlake.functions.iupac import AMINO, BASES, COMPLEMENT_FROM, COMPLEMENT_TO, OTHER_LETTERS, resolved_by_letter
from strandlake.operators.align import align, best_alignment
from strandlake.operators.frames import fix_frames_udf
from strandlake.plans.module import Module
from strandlake.sources.config import Penalties


def register(spark: SparkSession, module: Module | None = None) -> None:
    """nt_sanitize, revcomp and nt_translate are SQL functions; nt_align(query, reference, match, mismatch, open,
    extend) and fix_frames(states, nt, reference_id, ctype, product_name) run in Python, and so does the table
    function nt_annotate(seq, ctype), which gives the best alignment to each reference group of a module."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION nt_sanitize(s STRING) RETURNS STRING RETURN translate(upper(regexp_replace(s, '[^A-Za-z]', '')), '{OTHER_LETTERS}', '{'N' * len(OTHER_LETTERS)}')")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION revcomp(s STRING) RETURNS STRING RETURN translate(reverse(s), '{COMPLEMENT_FROM}', '{COMPLEMENT_TO}')")
    place = " + ".join(f"{k} * (instr('{BASES}', substring(c, {i}, 1)) - 1)" for i, k in ((1, 16), (2, 4), (3, 1)))
    unsure = " ".join(f"WHEN instr('{texts}', c) > 0 THEN '{letter}'" for letter, texts in resolved_by_letter().items())
    codon = f"CASE WHEN c RLIKE '^[{BASES}]{{3}}$' THEN substring('{AMINO}', {place} + 1, 1) WHEN c = '---' THEN '-' WHEN c RLIKE '^[-.]{{3}}$' THEN '.' WHEN length(c) < 3 OR c RLIKE '[-.]' THEN '~' {unsure} ELSE 'X' END"
    cuts = "CASE WHEN s = '' THEN array() ELSE sequence(0, (length(s) - 1) div 3) END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION nt_translate(s STRING) RETURNS STRING RETURN array_join(transform(transform({cuts}, i -> translate(substring(s, int(3 * i + 1), 3), 'U', 'T')), c -> {codon}), '')")
    schema = T._parse_datatype_string("score int, q_start int, q_end int, r_start int, r_end int, cigar string")

    @F.udf(returnType=schema, useArrow=True)
    def nt_align(query, reference, match, mismatch, gap_open, gap_extend):
        a = align(query, reference, Penalties(match, mismatch, gap_open, gap_extend)) if query and reference else None
        return a and (a.score, a.q_start, a.q_end, a.r_start, a.r_end, a.cigar)

    spark.udf.register("nt_align", nt_align)
    spark.udf.register("fix_frames", fix_frames_udf(module.shapes() if module else {}))
    if module is not None:
        groups, config = module.groups(), module.config

        @F.udtf(returnType="reference_id string, " + schema.simpleString()[7:-1].replace(":", " "))
        class Annotate:
            def eval(self, seq: str, ctype: str):
                for (reference_id, own), seqs in groups.items():
                    found = best_alignment(seq, seqs, config.penalties(own), config.one_pass) if own == ctype and seq else None
                    if found:
                        a = found[1]
                        yield reference_id, a.score, a.q_start, a.q_end, a.r_start, a.r_end, a.cigar

        spark.udtf.register("nt_annotate", Annotate)
