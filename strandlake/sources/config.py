"""Files of a module: references, coding regions, codon weights, rewrite rules, and the list of modules.

These are small configuration files; they are read on the driver with their rules checked, and become DataFrames.
"""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from strandlake.functions.iupac import CODES
from strandlake.schema import AnnotationError

HEADER = ("reference_id", "ctype", "product_name", "coords", "required_beginning")


def parse_range(text: str) -> tuple[int, int]:
    m = re.fullmatch(r"\s*([0-9]+)\.\.([0-9]+)\s*", text)
    if not m or not 1 <= int(m[1]) <= int(m[2]):
        raise AnnotationError(f"not a range: {text!r}")
    return int(m[1]) - 1, int(m[2])


def parse_key(header: str) -> tuple[str, str]:
    """``reference_id|ctype[|...]``; both trimmed, not empty and without tabs."""
    parts = [p.strip(" \r\n") for p in header.split("|")]
    if len(parts) < 2 or not all(parts[:2]) or any("\t" in p for p in parts[:2]):
        raise AnnotationError(f"not a reference header: {header!r}")
    return parts[0], parts[1]


@dataclass(frozen=True)
class Reference:
    reference_id: str
    ctype: str
    file_order: int
    seq: str


def load_references(path: str | Path) -> list[Reference]:
    out = []
    for order, record in enumerate(x for x in re.split(r"(?m)^>", Path(path).read_text()) if x.strip()):
        header, _, body = record.partition("\n")
        seq = re.sub(r"\s", "", body).upper()
        bad = next((c for c in seq if c not in CODES), None)
        if bad is not None or not seq:
            raise AnnotationError(f"{header}: " + ("a gap in a reference" if bad in ("-", ".") else f"not a nucleotide: {bad!r}"))
        out.append(Reference(*parse_key(header), order, seq))
    return out


@dataclass(frozen=True)
class Spec:
    reference_id: str
    ctype: str
    product_name: str
    ranges: tuple[tuple[int, int], ...]
    required_start: str | None


def load_specs(path: str | Path) -> list[Spec]:
    """Comments and blank lines are skipped; a header line is optional and must name the columns."""
    out, seen = [], set()
    rows = [line.split("\t") for line in Path(path).read_text().splitlines() if line.strip() and not line.lstrip().startswith("#")]
    if rows and rows[0][0].strip().lower() == HEADER[0]:
        if tuple(x.strip().lower() for x in rows[0]) not in (HEADER, HEADER[:4]):
            raise AnnotationError(f"unexpected header: {rows[0]}")
        rows = rows[1:]
    for row in rows:
        cells = [x.strip() for x in row]
        if len(cells) not in (4, 5) or not all(cells[:4]):
            raise AnnotationError(f"not a coding region: {row}")
        start = cells[4].upper().replace("U", "T") if len(cells) == 5 and cells[4] else None
        if start is not None and not re.fullmatch("[ACGT]{3}", start):
            raise AnnotationError(f"not a start codon: {cells[4]!r}")
        if (cells[0], cells[2]) in seen:
            raise AnnotationError(f"{cells[0]}|{cells[2]} has more than one specification")
        seen.add((cells[0], cells[2]))
        out.append(Spec(*cells[:3], tuple(parse_range(x) for x in cells[3].split(";")), start))
    return out


def load_weights(path: str | Path) -> dict[tuple[str, str], dict[tuple[int, str], int]]:
    """Sections ``#reference_id|product`` of rows ``position codon count``."""
    out: dict[tuple[str, str], dict[tuple[int, str], int]] = {}
    section = None
    for line in Path(path).read_text().splitlines():
        if not line.strip():
            continue
        if line.startswith("#"):
            if section is not None and not out[section]:
                raise AnnotationError(f"empty section: {section}")
            section = parse_key(line[1:])
            if section in out:
                raise AnnotationError(f"repeated section: {section}")
            out[section] = {}
            continue
        if section is None:
            raise AnnotationError("weights before the first section")
        cells = line.split()
        codon = cells[1].upper().replace("U", "T") if len(cells) == 3 else ""
        if not re.fullmatch("[" + "".join(CODES) + "]{3}", codon) or not cells[0].isdigit() or not cells[2].isdigit() or int(cells[0]) < 1:
            raise AnnotationError(f"not a weight: {line!r}")
        if (int(cells[0]), codon) in out[section]:
            raise AnnotationError(f"repeated weight: {line!r}")
        out[section][int(cells[0]), codon] = int(cells[2])
    if section is not None and not out[section]:
        raise AnnotationError(f"empty section: {section}")
    return out


@dataclass(frozen=True, order=True)
class Rule:
    """A deletion that is written elsewhere."""

    from_start: int
    from_end: int
    to_start: int
    to_end: int


def _needed(table: dict, name: str, what: str):
    """A field that must be there."""
    if name not in table:
        raise AnnotationError(f"{what}: no {name}")
    return table[name]


def _only(table: dict, known: set[str], what: str) -> dict:
    if set(table) - known:
        raise AnnotationError(f"unknown fields of {what}: {sorted(set(table) - known)}")
    return table


def load_rules(path: str | Path) -> dict[tuple[str, str], list[Rule]]:
    """Rules by (reference_id, ctype), sorted."""
    out: dict[tuple[str, str], list[Rule]] = {}
    found = _only(tomllib.loads(Path(path).read_text()), {"genome"}, "rewrite rules").get("genome", {})
    for entry in _only(found, {"deletions"}, "genome").get("deletions", []):
        rule = _only(_needed(_only(entry, {"rule"}, "deletions"), "rule", "deletions"), {"ctype", "reference_id", "from", "to"}, "rule")
        a, b = (parse_range(_needed(rule, x, "rule")) for x in ("from", "to"))
        if a[1] - a[0] != b[1] - b[0] or a == b:
            raise AnnotationError(f"ranges must differ and be of one length: {rule}")
        out.setdefault((_needed(rule, "reference_id", "rule"), _needed(rule, "ctype", "rule")), []).append(Rule(*a, *b))
    return {k: sorted(v) for k, v in out.items()}


@dataclass(frozen=True)
class Penalties:
    match: int
    mismatch: int
    gap_open: int
    gap_extend: int

    @classmethod
    def of(cls, table: dict) -> Penalties:
        """Penalties may be given with either sign and are kept as costs."""
        _only(table, {"match", "mismatch", "gap_open", "gap_extend"}, "alignment")
        if any(not isinstance(v, int) or not -128 < v < 128 for v in table.values()):
            raise AnnotationError(f"alignment parameters must be between -127 and 127: {table}")
        match, *costs = (_needed(table, x, "alignment") for x in ("match", "mismatch", "gap_open", "gap_extend"))
        out = cls(match, *map(abs, costs))
        if out.gap_open == 0 and out.gap_extend == 0:
            raise AnnotationError("gap_open and gap_extend can't both be 0")
        return out


@dataclass(frozen=True)
class ModuleConfig:
    name: str
    version: str | None
    references: str
    cds_spec: str
    alignment: dict[str, Penalties]
    weights: str | None = None
    rewrite_rules: str | None = None
    alternative_names: tuple[str, ...] = ()
    one_pass: bool = False
    try_stop_extension: bool = False
    chew_to_start: bool = False
    repairable_end_limit: int = 0
    right_pad_aa: bool = True
    right_pad_cds: bool = True
    right_pad_gen: bool = True
    folder: Path = field(default=Path("."), compare=False)

    def penalties(self, ctype: str) -> Penalties:
        return self.alignment.get(ctype, self.alignment["default"])

    def path(self, name: str) -> Path:
        own = self.folder / self.name / name
        return own if own.exists() else self.folder / name


def load_modules(path: str | Path) -> list[ModuleConfig]:
    out: list[ModuleConfig] = []
    names: set[str] = set()
    table = _only(tomllib.loads(Path(path).read_text()), {"module"}, "modules")
    for m in table.get("module", []):
        _only(m, {"name", "version", "alternative_names", "references", "weights", "cds_spec", "experimental", "alignment_method", "formatting", "rules", "alignment"}, "module")
        rules = _only(m.get("rules", {}), {"try_stop_extension", "chew_to_start", "repairable_end_limit"}, "rules")
        shown = _only(m.get("formatting", {}), {"right_pad_aa", "right_pad_cds", "right_pad_gen"}, "formatting")
        method = m.get("alignment_method", "three-pass")
        if method not in ("one-pass", "three-pass"):
            raise AnnotationError(f"unknown alignment method: {method}")
        own = _needed(m, "name", "module")
        if "default" not in _needed(m, "alignment", own):
            raise AnnotationError(f"{own}: no default alignment")
        for name in (own, *m.get("alternative_names", ())):
            if name.lower() in names:
                raise AnnotationError(f"repeated module name: {name}")
            names.add(name.lower())
        out.append(
            ModuleConfig(
                own, m.get("version"), _needed(m, "references", own), _needed(m, "cds_spec", own), {k: Penalties.of(v) for k, v in m["alignment"].items()}, m.get("weights"),
                _only(m.get("experimental", {}), {"rewrite_rules"}, "experimental").get("rewrite_rules"), tuple(m.get("alternative_names", ())), method == "one-pass", **rules, **shown, folder=Path(path).parent,
            )
        )
    return out


def find_module(modules: list[ModuleConfig], name: str) -> ModuleConfig:
    """By name or alternative name, ignoring case."""
    for m in modules:
        if name.lower() in (x.lower() for x in (m.name, *m.alternative_names)):
            return m
    raise AnnotationError(f"no such module: {name}")
