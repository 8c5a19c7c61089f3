"""Conversation repair against a search over all edits."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from tillgrain.llm import conversations as conv

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, copies string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    made = []
    for c, turn, role, text in rows:
        said = lambda x: " " if x is None else str(x)
        role, text = said(role), said(text)
        way = zlib.crc32(f"{said(c)}:{said(turn)}".encode()) % 20
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        made += [(c, turn, role, text)] * {0: 0, 3: 2}.get(way, 1)
    return made


def cheapest(rows):
    """Least (cost, audit) with its lines, by best-first search over rows read and initials given."""
    moves = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, lines = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, lines
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for other, name in (("u", "user"), ("a", "assistant")):
            if other in moves[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", at, other, lines + (f"{name}:",)))
        if at == len(rows):
            continue
        role, text, fault = rows[at]
        heapq.heappush(heap, (cost + 2, audit + "D", at + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        more = 5 if fault == "truncated" else 0
        if role[:1] and role[0] in moves[state]:
            heapq.heappush(heap, (cost + more, audit + "K", at + 1, role[0], lines + (f"{role}:{text}",)))
        for other, name in (("u", "user"), ("a", "assistant")):
            if other in moves[state]:
                heapq.heappush(heap, (cost + 1 + more, audit + "R", at + 1, other,
                                      lines + (f"{name}:{text}",)))


def plain(rows):
    made = {}
    kept = damage(rows)
    for c in {r[0] for r in rows}:
        own = sorted((r for r in kept if r[0] == c), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(r[3].encode()).digest()))
        faults, seen = [], set()
        for _, _, role, text in own:
            bare = text.strip(SPACE)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {r[1] for r in own if r[1] is not None}
        pairs = itertools.pairwise(r[2][:1] for r in own)
        cost, audit, lines = cheapest([(r[2], r[3], f) for r, f in zip(own, faults)])
        made[c] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                   *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                   sum(a + b not in ("su", "ua", "au") for a, b in pairs), cost, audit,
                   hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return made


def talk(seed, count, most):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(10_000), count):
        said = ["Hi.", "Ok!", "Why?", "no end", " \t\n", "", None, "x" * 50 + ".", "Ja. \x0b", "a "]
        for n in range(draw.randint(1, most)):
            turn = draw.choice([n, n, n, n + 3, max(0, n - 1), None])
            role = draw.choice(["user", "assistant"] * 4 + ["system", "tool", "", None, "аssistant"])
            rows.append((c, turn, role, draw.choice(said) if draw.random() < 0.3 else f"Line {draw.random()}."))
    return rows


@pytest.mark.parametrize("seed,count,most,piece", [(1, 250, 6, 4096), (2, 60, 25, 3), (3, 12, 120, 7)])
def test_repairs_are_cheapest_and_least(spark, seed, count, most, piece):
    rows = talk(seed, count, most)
    rows += [(None, 1, "user", "Hello."), (None, None, None, None), (None, 2, "assistant", "Yes.")]
    rows += [(20_001, 5, "user", "Same.")] * 9 + [(20_002, t, "user", "Same.") for t in range(9)]
    # Every row of these is dropped.
    rows += [(c, 0, "user", "Gone.") for c in range(30_000, 30_200)
             if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    frame = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA).repartition(3)
    got = {r[0]: tuple(r)[1:] for r in conv.repair(conv.damaged(frame), piece=piece).collect()}
    want = plain(rows)
    assert len(got) == len(want)
    assert {c: (got[c], want[c]) for c in want if got[c] != want[c]} == {}
    for _, *_, audit, _ in want.values():
        assert set(audit) <= set("DIKR")


def test_no_rows(spark):
    assert conv.repair(conv.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_pieces_agree_with_the_whole():
    """Costs by doubling equal row by row products."""
    draw = np.random.default_rng(4)
    initial = draw.choice([ord(c) for c in "suax"], 300).astype(np.uint8)
    arcs = conv.row_arcs(initial, draw.integers(0, 4, 300).astype(np.uint8),
                         draw.choice([1, 1, 1, 4], 300).astype(np.int64))
    single = conv.row_matrices(arcs)
    ends = np.repeat([100, 101, 300], [100, 1, 199])
    whole = conv.suffix_products(single, ends)
    for at in range(300):
        step = single[at]
        for n in range(at + 1, ends[at]):
            step = conv.product(step, single[n])
        assert (step == whole[at]).all()


def test_long_conversation_in_one_piece():
    """Twenty thousand rows: the least path is read off in a few steps of doubling."""
    draw = np.random.default_rng(6)
    n = 20_000
    arcs = conv.row_arcs(draw.choice([ord("u"), ord("a")], n).astype(np.uint8),
                         np.zeros(n, np.uint8), np.ones(n, np.int64))
    ends = np.full(n, n)
    whole = conv.suffix_products(conv.row_matrices(arcs), ends)
    costs = (whole + conv.END[None, None, :]).min(axis=2)
    words, left = conv.least_paths(arcs, np.array([0]), np.array([n]), np.array([True]),
                                   conv.END[None, :], costs)
    spent = {"D": 2, "I": 5, "K": 0, "R": 1}
    assert sum(spent[chr(c)] for c in words[0, 0]) == costs[0, 0] and left[0, 0] in (0, 3)
