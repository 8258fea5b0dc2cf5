"""Types of the nested columns and of the six result tables.

Coordinates inside are 0-based and half-open; text forms are 1-based and inclusive. An insertion point is the index
of the base to its right.
"""

from __future__ import annotations

STATE = "struct<op:string,q_start:int,q_end:int,r_start:int,r_end:int>"
STATES = f"array<{STATE}>"
CDS_STATE = "struct<op:string,q_start:int,q_end:int,c_start:int,c_end:int>"
CDS_STATES = f"array<{CDS_STATE}>"
EXON = "struct<ref_start:int,ref_end:int,cds_start:int,cds_end:int>"
REGION = "struct<start:int,mid_end:int,mid_start:int,end:int>"

PRODUCT_KEYS = "query_id string, ctype string, reference_id string, product_name string"
GENOME_KEYS = "query_id string, ctype string, reference_id string"

#: Columns of the result tables in file order.
TABLES = {
    "seq": f"{PRODUCT_KEYS}, variant_hash string, aa_seq string, aa_aln string, cds_id string, has_insertion boolean, has_shift_indel boolean, cds_seq string, cds_aln string, query_coordinates string, cds_coordinates string",
    "ins": f"{PRODUCT_KEYS}, upstream_aa_pos int, inserted_nt string, inserted_aa string, upstream_nt_pos int, codon_shift int",
    "del": f"{PRODUCT_KEYS}, variant_hash string, del_aa_start int, del_aa_end int, del_aa_len int, in_frame boolean, cds_id string, del_cds_start int, del_cds_end int, del_cds_len int",
    "gen_seq": f"{GENOME_KEYS}, genome_id string, genome_length int, has_insertion boolean, genome_seq string, genome_aln string",
    "gen_ins": f"{GENOME_KEYS}, upstream_nt_pos int, inserted_nt string",
    "gen_del": f"{GENOME_KEYS}, del_start int, del_end int, del_len int",
}


def names(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].split(", ")]


class AnnotationError(ValueError):
    """A configuration or an input that can't be annotated."""
