"""Shift directions, merging, rewriting, and invariants of the sequential steps."""

import random

import pytest

from strandlake.operators.frames import Overlap, ProductShape, Segment, deletion_direction, fix_frames, insertion_direction, rewrite_deletions
from strandlake.sources.config import Rule

INSERTIONS = [("left1", 1, 1, 10, "L"), ("left1_default", 1, 1, 1, "L"), ("left2", 2, 1, 10, "L"), ("right1", 2, 10, 1, "R"), ("right1_default", 2, 1, 1, "R"), ("right2", 1, 10, 1, "R")]


@pytest.mark.parametrize("name,at,acg,tac,want", INSERTIONS)
def test_insertion_direction(name, at, acg, tac, want):
    shape = ProductShape(weights={(1, "ACG"): acg, (1, "TAC"): tac})
    left, gap, right = Segment("M", 0, at, 0, at), Segment("I", at, at + 3, at, at), Segment("M", at + 3, 6, at, 3)
    assert insertion_direction(left, gap, right, "ACGTAC", shape) == want


DELETIONS = [("left1", 1, 1, 10, "L"), ("left1_default", 1, 1, 1, "L"), ("left2", 2, 1, 10, "L"), ("right1", 2, 10, 1, "R"), ("right1_default", 2, 1, 1, "R"), ("right2", 1, 10, 1, "R")]


@pytest.mark.parametrize("name,at,w1,w2,want", DELETIONS)
def test_deletion_direction(name, at, w1, w2, want):
    shape = ProductShape(weights={(1, "ACG"): w1, (2, "ACG"): w2})
    left, gap, right = Segment("M", 0, at, 0, at), Segment("D", None, None, at, at + 3), Segment("M", at, 3, at + 3, 6)
    assert deletion_direction(left, gap, right, "ACG", shape) == want


def text(segments):
    return [(s.op, s.q_start, s.q_end, s.c_start, s.c_end) for s in segments]


def test_deletion_moves_left_and_merges():
    got = fix_frames([Segment("M", 0, 7, 0, 7), Segment("D", None, None, 7, 10), Segment("M", 7, 15, 10, 18)], "ATGAAACGGTTTTAA", ProductShape())
    assert text(got) == [("M", 0, 6, 0, 6), ("D", None, None, 6, 9), ("M", 6, 15, 9, 18)]
    got = fix_frames([Segment("M", 0, 6, 0, 6), Segment("D", None, None, 6, 9), Segment("M", 6, 7, 9, 10), Segment("D", None, None, 10, 13), Segment("M", 7, 12, 13, 18)], "ATGAAACGGTTT", ProductShape())
    assert text(got) == [("M", 0, 6, 0, 6), ("D", None, None, 6, 12), ("M", 6, 12, 12, 18)]


def test_deletions_stay_apart_around_a_gap():
    two = [Segment("M", 0, 3, 0, 3), Segment("D", None, None, 3, 6), Segment("D", None, None, 6, 9), Segment("M", 3, 6, 9, 12)]
    assert len(fix_frames(two, "ATGAAA", ProductShape(gaps=(6,)))) == 4
    assert len(fix_frames(two, "ATGAAA", ProductShape())) == 3


def test_insertion_moved_to_the_start_or_to_a_gap_goes():
    got = fix_frames([Segment("M", 0, 1, 0, 1), Segment("I", 1, 4, 1, 1), Segment("M", 4, 9, 1, 6)], "ATGAAACCC", ProductShape(weights={(1, "AAA"): 9}))
    assert text(got) == [("M", 3, 9, 0, 6)]
    got = fix_frames([Segment("M", 0, 4, 0, 4), Segment("I", 4, 7, 4, 4), Segment("M", 7, 12, 4, 9)], "ATGAAACCCGGG", ProductShape(gaps=(3,), weights={(2, "CCC"): 9}))
    assert text(got) == [("M", 0, 3, 0, 3), ("M", 6, 12, 3, 9)]


def test_overlap_bounds_a_shift():
    shape = ProductShape(overlaps=(Overlap(4, 5, 5, 6),))
    gap = [Segment("M", 0, 7, 0, 7), Segment("D", None, None, 7, 10), Segment("M", 7, 15, 10, 18)]
    assert fix_frames(gap, "ATGAAACGGTTTTAA", shape)[1].c_start == 6
    assert fix_frames(gap, "ATGAAACGGTTTTAA", ProductShape(overlaps=(Overlap(5, 6, 6, 7),)))[1].c_start == 9
    inside = [Segment("M", 0, 5, 0, 5), Segment("D", None, None, 5, 8), Segment("M", 5, 15, 8, 18)]
    assert text(fix_frames(inside, "ATGAAACGGTTTTAA", shape)) == text(inside)


def test_rewrite():
    states = [Segment("M", 0, 20, 0, 20), Segment("D", None, None, 20, 23), Segment("M", 20, 40, 23, 43)]
    got, fired = rewrite_deletions(states, [Rule(20, 23, 14, 17)])
    assert fired and text(got) == [("M", 0, 14, 0, 14), ("D", None, None, 14, 17), ("M", 14, 40, 17, 43)]
    got, fired = rewrite_deletions(states, [Rule(20, 23, 26, 29)])
    assert fired and text(got) == [("M", 0, 26, 0, 26), ("D", None, None, 26, 29), ("M", 26, 40, 29, 43)]
    assert not rewrite_deletions(states, [Rule(20, 23, 0, 3)])[1]
    assert not rewrite_deletions(states, [Rule(19, 22, 14, 17)])[1]


def test_lengths_are_kept():
    rng = random.Random(4)
    for _ in range(300):
        segments, q, c = [], 0, 0
        for k in range(rng.randint(1, 9)):
            op = "M" if k % 2 == 0 else rng.choice("ID")
            n = rng.randint(1, 7)
            dq, dc = (0 if op == "D" else n), (0 if op == "I" else n)
            segments.append(Segment(op, None if op == "D" else q, None if op == "D" else q + dq, c, c + dc))
            q, c = q + dq, c + dc
        got = fix_frames(segments, "".join(rng.choice("ACGT") for _ in range(q)), ProductShape())
        assert sum(s.c_end - s.c_start for s in got) == c
        assert all(s.size > 0 for s in got)
        assert all(a.c_end == b.c_start for a, b in zip(got, got[1:], strict=False))
