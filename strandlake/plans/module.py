"""A module: references, coding regions, weights and rules, checked and joined into small tables."""

from __future__ import annotations

from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.operators.frames import ProductShape, overlaps_and_gaps
from strandlake.schema import EXON, AnnotationError
from strandlake.sources.config import ModuleConfig, Reference, Rule, Spec, find_module, load_modules, load_references, load_rules, load_specs, load_weights, parse_key

MOST_SHARED = 2


def exon_coords(ranges: tuple[tuple[int, int], ...]) -> list[tuple[int, int, int, int]]:
    """(ref_start, ref_end, cds_start, cds_end) of each exon, in order."""
    out, at = [], 0
    for s, e in ranges:
        out.append((s, e, at, at + e - s))
        at += e - s
    return out


def check_exons(name: str, exons: list[tuple[int, int, int, int]], ref_len: int) -> None:
    """Exons are in order, not within each other, share two bases at most and none among three, don't adjoin, lie
    within the reference, and have whole codons together."""
    if not exons:
        raise AnnotationError(f"{name}: no exons")
    if exons[-1][3] % 3:
        raise AnnotationError(f"{name}: {exons[-1][3]} bases are no whole codons")
    if max(e[1] for e in exons) > ref_len:
        raise AnnotationError(f"{name}: beyond the end of the reference ({ref_len})")
    for a, b in zip(exons, exons[1:], strict=False):
        if b[0] <= a[0] or b[1] <= a[1]:
            raise AnnotationError(f"{name}: exons out of order or within each other")
        if a[1] == b[0]:
            raise AnnotationError(f"{name}: adjoining exons are one")
        if a[1] - b[0] > MOST_SHARED:
            raise AnnotationError(f"{name}: exons share more than {MOST_SHARED} bases")
    for a, c in zip(exons, exons[2:], strict=False):
        if a[1] > c[0]:
            raise AnnotationError(f"{name}: three exons share bases")


@dataclass(frozen=True)
class Module:
    config: ModuleConfig
    references: tuple[Reference, ...]
    specs: tuple[Spec, ...]
    weights: dict[tuple[str, str], dict[tuple[int, str], int]]
    rules: dict[tuple[str, str], list[Rule]]

    def __post_init__(self):
        lengths: dict[tuple[str, str], set[int]] = {}
        for r in self.references:
            lengths.setdefault((r.reference_id, r.ctype), set()).add(len(r.seq))
        uneven = [k for k, v in lengths.items() if len(v) > 1]
        if uneven:
            raise AnnotationError(f"references of one group differ in length: {uneven}")
        for what, keys in (("coding regions", [(s.reference_id, s.ctype) for s in self.specs]), ("rewrite rules", list(self.rules))):
            if lost := sorted(set(keys) - set(lengths)):
                raise AnnotationError(f"{what} without a reference: {lost}")
        known = {(s.reference_id, s.product_name) for s in self.specs}
        if lost := sorted(set(self.weights) - known):
            raise AnnotationError(f"weights without a coding region: {lost}")
        for s in self.specs:
            check_exons(f"{s.reference_id}|{s.product_name}", exon_coords(s.ranges), *lengths[s.reference_id, s.ctype])

    @property
    def have_weights(self) -> bool:
        return bool(self.weights)

    def groups(self) -> dict[tuple[str, str], list[str]]:
        out: dict[tuple[str, str], list[str]] = {}
        for r in sorted(self.references, key=lambda r: r.file_order):
            out.setdefault((r.reference_id, r.ctype), []).append(r.seq)
        return out

    def shapes(self) -> dict[tuple[str, str, str], ProductShape]:
        return {(s.reference_id, s.ctype, s.product_name): ProductShape(*overlaps_and_gaps(exon_coords(s.ranges)), self.weights.get((s.reference_id, s.product_name), {})) for s in self.specs}

    def group_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(r, c, len(seqs[0])) for (r, c), seqs in self.groups().items()], "reference_id string, ctype string, ref_len int")

    def product_table(self, spark: SparkSession) -> DataFrame:
        rows = [(s.reference_id, s.ctype, s.product_name, exon_coords(s.ranges), s.required_start) for s in self.specs]
        return spark.createDataFrame(rows, f"reference_id string, ctype string, product_name string, exons array<{EXON}>, required_start string")


#: A module's table of at most so many rows is sent to all executors; a larger one is joined as Spark sees fit. Spark
#: doesn't know the size of rows given by the driver, and a shuffle on the reference would put most rows in one task.
MOST_SENT = 100_000


def sent(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= MOST_SENT else table


def build(config: ModuleConfig) -> Module:
    return Module(
        config,
        tuple(load_references(config.path(config.references))),
        tuple(load_specs(config.path(config.cds_spec))),
        load_weights(config.path(config.weights)) if config.weights and config.path(config.weights).exists() else {},
        load_rules(config.path(config.rewrite_rules)) if config.rewrite_rules else {},
    )


def load(modules_dir: str | Path, name: str = "flu") -> Module:
    return build(find_module(load_modules(Path(modules_dir) / "modules.toml"), name))


def ctypes_elsewhere(spark: SparkSession, modules_dir: str | Path, but: str) -> DataFrame:
    """(module_order, module, ctype) of the references of the other modules; files that can't be read are left out."""
    rows = []
    for k, m in enumerate(load_modules(Path(modules_dir) / "modules.toml")):
        if m.name == but:
            continue
        try:
            lines = m.path(m.references).read_text().splitlines()
        except (OSError, UnicodeDecodeError):
            continue
        for line in lines:
            if line.startswith(">"):
                try:
                    rows.append((k, m.name, parse_key(line[1:])[1]))
                except AnnotationError:
                    continue
    return spark.createDataFrame(sorted(set(rows)), "module_order int, module string, ctype string")
