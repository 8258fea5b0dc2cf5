"""Moving indels into frame, and rewriting deletions: the two steps that go through the states in order.

Both are functions on the list of states of one row, called through an Arrow function on the rows that need them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import functions as F

from strandlake.schema import CDS_STATES, STATES
from strandlake.sources.config import Rule

#: Codons from the least to the most usual; the weight of each is ten times its place. Used for
#: insertions without counts of their own.
USUAL_CODONS = """
TAG TGA TAA CGT CGC TCG GCG CCG ACG CGG CGA CAC CCC TGT TTA GGC CAT GGT TCC GTC TGC CCT CTC GTA TAC GCC TCT ACC CTA GTT TAT AGT
TTG CCA CTG AGC GCT TGG CTT TTT GGG ATC AGG ACT CAG TCA GTG TTC GAC AAG CAA AAC ATT GCA ATA GAT ACA GGA GAG AAT AGA AAA ATG GAA
""".split()
_USUAL = {codon: 10 * (k + 1) for k, codon in enumerate(USUAL_CODONS)}


@dataclass
class Segment:
    """A match, insertion or deletion of a product; insertions have c_start = c_end, deletions no query range."""

    op: str
    q_start: int | None
    q_end: int | None
    c_start: int
    c_end: int

    @property
    def size(self) -> int:
        return (self.c_end - self.c_start) if self.op == "D" else self.q_end - self.q_start


@dataclass(frozen=True)
class Overlap:
    """Two exons that share bases: where the first copy begins and ends, and the second."""

    start: int
    mid_end: int
    mid_start: int
    end: int


@dataclass(frozen=True)
class ProductShape:
    overlaps: tuple[Overlap, ...] = ()
    gaps: tuple[int, ...] = ()  # coding positions before which bases of the genome aren't coding
    weights: dict[tuple[int, str], int] = field(default_factory=dict)


def overlaps_and_gaps(exons: list[tuple[int, int, int, int]]) -> tuple[tuple[Overlap, ...], tuple[int, ...]]:
    """From exons as (ref_start, ref_end, cds_start, cds_end)."""
    overlaps, gaps = [], []
    for (_, a_end, _, a_cds_end), (b_start, _, b_cds, _) in zip(exons, exons[1:], strict=False):
        shared = a_end - b_start
        if shared > 0:
            overlaps.append(Overlap(a_cds_end - shared, a_cds_end, b_cds, b_cds + shared))
        elif shared < 0:
            gaps.append(b_cds)
    return tuple(overlaps), tuple(gaps)


def _choose(shift: int, most_left: int, most_right: int, prefer) -> str | None:
    """Left, right or not at all; ``prefer`` compares weights where both ways are open."""
    left, right = most_left >= shift, most_right >= 3 - shift
    if left and right:
        return prefer() or ("L" if shift == 1 else "R")
    return "L" if left else "R" if right else None


def deletion_direction(left: Segment, gap: Segment, right: Segment, nt: str, shape: ProductShape) -> str | None:
    if left.q_end != right.q_start:
        return None
    most_left, most_right = min(2, left.size), min(2, right.size)
    touched = [o for o in shape.overlaps if (gap.c_end > o.start and o.mid_end > gap.c_start) or (gap.c_end > o.mid_start and o.end > gap.c_start)]
    if touched:
        lo, hi = touched[0].start, touched[-1].end
        if not (gap.c_start <= lo and hi <= gap.c_end):
            return None
        most_left, most_right = min(most_left, gap.c_end - hi), min(most_right, lo - gap.c_start)
    before = [gap.c_start - o.end for o in shape.overlaps if o.end <= gap.c_start]
    after = [o.start - gap.c_end for o in shape.overlaps if o.start >= gap.c_end]
    most_left, most_right = min([most_left, *before]), min([most_right, *after])
    shift = gap.c_start % 3

    def by_weight() -> str | None:
        codon = nt[left.q_end - shift : left.q_end + 3 - shift].replace("U", "T")
        a, b = (shape.weights.get((at, codon), 0) for at in (gap.c_start // 3 + 1, (gap.c_end - 1) // 3 + 1))
        return "L" if a < b else "R" if a > b else None

    return _choose(shift, most_left, most_right, by_weight)


def insertion_direction(left: Segment, gap: Segment, right: Segment, nt: str, shape: ProductShape) -> str | None:
    at = gap.c_start
    if left.c_end != right.c_start or any(o.start < at < o.end for o in shape.overlaps):
        return None
    most_left = min([2, left.size, *(at - o.end for o in shape.overlaps if o.end <= at)])
    most_right = min([2, right.size, *(o.start - at for o in shape.overlaps if o.start >= at)])
    shift = at % 3

    def by_weight() -> str | None:
        inserted = nt[gap.q_start : gap.q_end]
        kept_left, kept_right = nt[left.q_end - shift : left.q_end], nt[right.q_start : right.q_start + 3 - shift]
        if_right = (kept_left + inserted[: 3 - shift]).replace("U", "T")
        if_left = (inserted[-shift:] + kept_right).replace("U", "T")
        place = at // 3 + 1
        a, b = shape.weights.get((place, if_left), 0), shape.weights.get((place, if_right), 0)
        if not a and not b:
            a, b = _USUAL.get(if_left, 0), _USUAL.get(if_right, 0)
        return "L" if a > b else "R" if a < b else None

    return _choose(shift, most_left, most_right, by_weight)


def _move(left: Segment, gap: Segment, right: Segment, direction: str) -> None:
    shift = gap.c_start % 3
    n = -shift if direction == "L" else 3 - shift
    gap.c_start += n
    gap.c_end += n
    left.q_end += n
    left.c_end += n
    right.q_start += n
    right.c_start += n
    if gap.op == "I":
        gap.q_start += n
        gap.q_end += n


def _may_merge(a: Segment, b: Segment, shape: ProductShape) -> bool:
    def side(x: Segment, at: int) -> int:
        return 1 if at <= x.c_start else -1 if x.c_end <= at else 0

    return all(side(a, g) == side(b, g) for g in shape.gaps)


def fix_frames(segments: list[Segment], nt: str, shape: ProductShape) -> list[Segment]:
    """Indels of whole codons that lie within a codon move to a border of it, by weights where both ways are open.

    Segments that become empty go; deletions that meet are joined unless bases between them aren't coding; insertions
    that meet are joined, and those moved to the end of the product or to a non-coding region are dropped.
    """
    out = [Segment(s.op, s.q_start, s.q_end, s.c_start, s.c_end) for s in segments]
    i = 0
    while i < len(out):
        gap = out[i]
        left, right = out[i - 1] if i else None, out[i + 1] if i + 1 < len(out) else None
        if gap.op == "D" and right is not None and right.op == "D":
            if _may_merge(gap, right, shape):
                gap.c_end = right.c_end
                del out[i + 1]
            else:
                i += 1
            continue
        flanked = gap.op != "M" and left is not None and right is not None and left.op == right.op == "M"
        if not flanked or gap.c_start % 3 == 0 or gap.size % 3:
            i += 1
            continue
        direction = (deletion_direction if gap.op == "D" else insertion_direction)(left, gap, right, nt, shape)
        if direction is None:
            i += 1
            continue
        _move(left, gap, right, direction)
        drop_gap = gap.op == "I" and gap.c_start in shape.gaps
        gone = []
        if not left.size:
            gone.append(left)
            outer = out[i - 2] if i >= 2 else None
            if gap.op == "I":
                if outer is None:
                    drop_gap = True
                elif outer.op == "I" and not drop_gap:
                    outer.q_end, drop_gap = gap.q_end, True
            elif outer is not None and outer.op == "D" and _may_merge(outer, gap, shape):
                outer.c_end, drop_gap = gap.c_end, True
        elif not right.size:
            gone.append(right)
            outer = out[i + 2] if i + 2 < len(out) else None
            if gap.op == "I":
                if outer is None:
                    drop_gap = True
                elif outer.op == "I" and not drop_gap:
                    gap.q_end = outer.q_end
                    gone.append(outer)
        following = next((s for s in out[i + 1 :] if not any(s is g for g in gone)), None)
        if drop_gap:
            gone.append(gap)
        out = [s for s in out if not any(s is g for g in gone)]
        i = next((k for k, s in enumerate(out) if s is following), len(out))
    return out


def rewrite_deletions(states: list[Segment], rules: list[Rule]) -> tuple[list[Segment], bool]:
    """Deletions of the genome at a rule's place move to where it says, if a longer match stands on that side. Rules
    are sorted; each is used once and each deletion moves at most once. c_* are reference coordinates here."""
    out = [Segment(s.op, s.q_start, s.q_end, s.c_start, s.c_end) for s in states]
    left_over, fired, i = list(rules), False, 0
    while i < len(out):
        gap = out[i]
        i += 1
        if gap.op != "D":
            continue
        place = (gap.c_start, gap.c_end)
        while left_over and (left_over[0].from_start, left_over[0].from_end) < place:
            left_over.pop(0)
        if not left_over or (left_over[0].from_start, left_over[0].from_end) != place:
            continue
        rule = left_over.pop(0)
        step = rule.to_start - rule.from_start
        at = i - 1
        giver = (out[at - 1] if at else None) if step < 0 else (out[at + 1] if at + 1 < len(out) else None)
        taker = (out[at + 1] if at + 1 < len(out) else None) if step < 0 else (out[at - 1] if at else None)
        if giver is None or giver.op != "M" or giver.size <= abs(step):
            continue
        fired = True
        gap.c_start += step
        gap.c_end += step
        if step < 0:
            giver.q_end += step
            giver.c_end += step
            if taker is not None and taker.op == "M":
                taker.q_start += step
                taker.c_start += step
            else:
                out.insert(at + 1, Segment("M", giver.q_end, giver.q_end - step, gap.c_end, gap.c_end - step))
                i += 1
        else:
            giver.q_start += step
            giver.c_start += step
            if taker is not None and taker.op == "M":
                taker.q_end += step
                taker.c_end += step
            else:
                out.insert(at, Segment("M", giver.q_start - step, giver.q_start, gap.c_start - step, gap.c_start))
                i += 1
    return out, fired


Shapes = dict[tuple[str, str, str], ProductShape]


def fix_frames_udf(shapes: Shapes):
    """(states, nt, reference_id, ctype, product_name) to the fixed states; null stays null."""

    @F.udf(returnType=CDS_STATES, useArrow=True)
    def fix(states, nt, reference_id, ctype, product_name):
        if states is None:
            return None
        shape = shapes.get((reference_id, ctype, product_name)) or ProductShape()
        made = fix_frames([Segment(*(s[k] for k in ("op", "q_start", "q_end", "c_start", "c_end"))) for s in states], nt, shape)
        return [(s.op, s.q_start, s.q_end, s.c_start, s.c_end) for s in made]

    return fix.asNondeterministic()  # so that no filter on its result is moved below it


def rewrite_udf(rules: dict[tuple[str, str], list[Rule]]):
    """(states, reference_id, ctype) to the rewritten states."""

    @F.udf(returnType=STATES, useArrow=True)
    def rewrite(states, reference_id, ctype):
        if states is None:
            return None
        made, _ = rewrite_deletions([Segment(*(s[k] for k in ("op", "q_start", "q_end", "r_start", "r_end"))) for s in states], rules.get((reference_id, ctype), []))
        return [(s.op, s.q_start, s.q_end, s.c_start, s.c_end) for s in made]

    return rewrite.asNondeterministic()
