"""Queries over the driver's tables, one module per family, each with its SQL where SQL can say it."""

from __future__ import annotations

from types import ModuleType

from pyspark.sql import functions as F

from strandlake.catalog import classification, relations, sequences, sequential
from strandlake.catalog.base import Query

FAMILIES: tuple[ModuleType, ...] = (sequences, relations, sequential, classification)
HELPERS = {"synthetic_module", "mutated", "placed"}

#: Integer columns that may be null; the queries and their SQL give -1 there, so their type is integer in any client.
NULLABLE = {
    "first_stop_prefix": ("stop_at",),
    "stop_extension": ("stop_end",),
    "coord_parse": ("end",),
    "range_intersect": ("i0", "i1", "o0", "o1"),
    "range_cmp": ("strict", "relaxed", "to_point"),
    "cigar_to_states": ("q_start", "q_end"),
    "exon_intersect": ("q_start", "q_end"),
    "nearest_region": ("to_left", "to_right"),
}


def _marked(query: Query, columns: tuple[str, ...]) -> Query:
    return lambda spark, sf: query(spark, sf).withColumns({c: F.coalesce(c, F.lit(-1).cast("long")) for c in columns})


def all_queries() -> dict[str, Query]:
    """The public functions of each family; helpers and imports are left out."""
    found = {k: v for m in FAMILIES for k, v in vars(m).items() if callable(v) and not k.startswith("_") and k not in HELPERS and getattr(v, "__module__", "") == m.__name__}
    return {k: _marked(v, NULLABLE[k]) if k in NULLABLE else v for k, v in found.items()}


def all_sql() -> dict[str, str]:
    found = {k: v for m in FAMILIES for k, v in m.SQL.items()}
    for name, columns in NULLABLE.items():
        found[name] = "SELECT * REPLACE (" + ", ".join(f'coalesce("{c}", -1) AS "{c}"' for c in columns) + f") FROM ({found[name]}) AS marked"
    return found
