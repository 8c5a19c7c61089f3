"""Vector codes and near-duplicate vectors against brute force."""

import hashlib
import math

import numpy as np
import pytest

from tillgrain.llm import pivots, tiles

SCHEMA = "vec_id bigint, embedding array<double>, label int, weight string, node string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "own", "own", "own") for i, v, label in rows], SCHEMA)


# ---- codes

def plain_codes(rows, parts, entries, rounds):
    """(id, vector, label) to sorted rows and codebooks, by looking at every entry."""
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and None not in v and all(map(math.isfinite, v)) and len(v) % parts == 0]
    first = {}
    for i, v, _ in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    width = len(first[min(first)]) // parts
    kept = [row for row in kept if len(row[1]) == width * parts]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    seeds = [first[i] for i in sorted(first)[:entries]]
    books = [[cut(v, p) for v in seeds] for p in range(parts)]

    def take(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [[[] for _ in seeds] for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                held[p][take(v, p)[1]].append(cut(v, p))
        books = [[[sum(c) // len(own) for c in zip(*own)] if own else old
                  for own, old in zip(held[p], books[p])] for p in range(parts)]
    made = [(i, label, [take(v, p) for p in range(parts)]) for i, v, label in kept]
    made = [(i, label, "".join(f"{n:02x}" for _, n in t), sum(d for d, _ in t)) for i, label, t in made]
    return sorted([(i, label, code, error, sum(e for _, x, _, e in made if x == label))
                   for i, label, code, error in made], key=repr), books


def odd_rows(seed, count, length):
    draw = np.random.default_rng(seed)
    rows = [(int(i), (draw.integers(-3, 4, length) / 16 + draw.normal(0, 0.01, length)).tolist(),
             int(draw.integers(3))) for i in draw.permutation(4 * count)[:count]]
    rows += [(7001, rows[3][1], None), (7002, rows[3][1], None), (rows[4][0], rows[5][1], 1),
             (None, rows[6][1], 2), (7003, None, 1), (7004, [0.5] * (length - 1) + [None], 1),
             (7005, [0.5] * (length - 1) + [float("nan")], 1), (7007, [float("inf")] * length, 1),
             (7008, [], 1), (7009, [0.0] * length, 1)]
    return rows


@pytest.mark.parametrize("seed,count,length,parts,entries,rounds", [
    (1, 90, 16, 4, 64, 2), (2, 60, 16, 16, 8, 3), (3, 7, 8, 2, 64, 2)])
def test_codes_match_a_full_scan(spark, seed, count, length, parts, entries, rounds):
    rows = odd_rows(seed, count, length)
    got, books = pivots.compress(frame(spark, rows).repartition(3), parts=parts, entries=entries,
                                 rounds=rounds)
    want, plain = plain_codes(rows, parts, entries, rounds)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want
    assert books.tolist() == plain
    flat = ",".join(str(c) for book in plain for entry in book for c in entry)
    assert pivots.digest(books) == hashlib.sha256(flat.encode()).hexdigest()


def test_pivots_spare_most_evaluations():
    draw = np.random.default_rng(5)
    parts, entries = draw.integers(-150, 150, (2_000, 4)), draw.integers(-150, 150, (64, 4))
    fixed = pivots.spread_pivots(entries, 5)
    at, error, evaluated = pivots.nearest(parts, pivots.squared(parts, fixed), fixed, entries)
    away = pivots.squared(parts, entries)
    assert (at == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
    assert evaluated < 0.15 * away.size


def test_ties_go_to_the_lower_entry():
    entries = np.array([[5, 0], [0, 0], [5, 0], [10, 0], [0, 0]])
    parts = np.array([[0, 0], [5, 0], [10, 0], [7, 0]])
    fixed = pivots.spread_pivots(entries, 2)
    at, error, _ = pivots.nearest(parts, pivots.squared(parts, fixed), fixed, entries)
    assert at.tolist() == [1, 0, 3, 0] and error.tolist() == [0, 0, 0, 4]


def test_large_components_stay_exact(spark):
    rows = [(1, [1e6, -1e6], 0), (2, [1e6 + 1, 3.0], 0), (3, [1e300, 0.0], 0), (4, [1e6, 2.0], 1)]
    got, books = pivots.compress(frame(spark, rows), parts=2, entries=2, rounds=1)
    want, plain = plain_codes([r for r in rows if r[0] != 3], 2, 2, 1)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == want and books.tolist() == plain


def test_no_vectors_no_codes(spark):
    for rows in ([], [(1, None, 1)], [(None, [1.0, 2.0], 1)]):
        got, books = pivots.compress(frame(spark, rows), parts=2)
        assert got.collect() == [] and books.size == 0


# ---- near duplicates

def plain_links(rows, threshold):
    able = [(n, i, np.array(v) / np.abs(v).max()) for n, (i, v, _) in enumerate(rows)
            if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    linked = {n: [] for n in range(len(rows))}
    root = {i: i for i, _, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i, x in able:
        for m, j, y in able:
            if n < m and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                linked[n].append(m)
                linked[m].append(n)
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted([(i, len(linked[n]), None if i is None else find(i))
                   for n, (i, _, _) in enumerate(rows)], key=repr)


def near_rows(seed, groups, length=12):
    draw = np.random.default_rng(seed)
    rows, ids = [], iter(draw.permutation(5_000).tolist())
    for size in groups:
        middle = draw.normal(0, 1, length)
        for _ in range(size):
            noise = draw.choice([0.0, 0.02, 0.1, 0.2])
            rows.append((next(ids), (draw.choice([1.0, 3.0]) * (middle + draw.normal(0, noise, length))
                                     ).tolist(), int(draw.integers(3))))
    rows += [(6001, rows[0][1], 1), (6002, rows[0][1], None), (rows[1][0], rows[-1][1], 0),
             (rows[2][0], rows[2][1], 0), (None, rows[3][1], 0), (6003, None, 0), (6004, [], 0),
             (6005, [0.0] * length, 0), (6006, [1.0] * (length - 1) + [None], 0),
             (6007, [1.0] * (length - 1) + [float("nan")], 0), (6008, [1e200] * length, 0),
             (6009, [1e-200] * length, 0), (6010, rows[0][1][:5], 0), (rows[4][0], None, 0),
             (6011, [-0.0] + [1.0] * (length - 1), 0), (6012, [0.0] + [1.0] * (length - 1), 0)]
    return rows


@pytest.mark.parametrize("seed,groups,cell_rows,tile", [
    (1, [1] * 30 + [4] * 6, 512, 2048),
    (2, [1] * 40 + [30, 12, 3, 3], 16, 2048),
    (3, [1] * 20 + [60, 25], 16, 8),
])
def test_links_of_near_vectors(spark, seed, groups, cell_rows, tile):
    rows = near_rows(seed, groups)
    got = tiles.link(frame(spark, rows).repartition(3), cell_rows=cell_rows, tile=tile, missed=1e-9)
    assert sorted([tuple(r) for r in got.collect()], key=repr) == plain_links(rows, 0.95)


def test_nothing_to_link(spark):
    assert tiles.link(frame(spark, [])).collect() == []
    got = tiles.link(frame(spark, [(4, None, 1), (5, [0.0], 2)]))
    assert sorted(map(tuple, got.collect())) == [(4, 0, 4), (5, 0, 5)]


def test_quantisation_bound_holds_and_spares_doubles():
    draw = np.random.default_rng(9)
    x = draw.normal(0, 1, (300, 64))
    y = np.concatenate([x[:150] + draw.normal(0, 0.3, (150, 64)), draw.normal(0, 1, (150, 64))])
    a, b = tiles.Side(x), tiles.Side(y)
    near = tiles.multiplied(a.steps, b.steps) * (a.scale[:, None] * b.scale[None, :])
    off = a.rest[:, None] + (1 + a.rest[:, None]) * b.rest[None, :] + tiles.SLACK
    exact = tiles.units_of(x) @ tiles.units_of(y).T
    assert (np.abs(near - exact) <= off).all()
    found, doubles = set(), 0
    for i, j, computed in tiles.links(a, b, 0.95):
        found |= set(zip(i.tolist(), j.tolist()))
        doubles += computed
    assert found == set(zip(*np.nonzero(exact >= 0.95))) and 0 < doubles < 200


def test_share_of_pairs_at_the_threshold_that_is_missed():
    draw = np.random.default_rng(12)
    length, bits = 64, tiles.bits_of(200_000, 64, 512)
    tables = tiles.tables_for(length, bits, 0.95, 0.001)
    x = tiles.units_of(draw.normal(0, 1, (4_000, length)))
    y = draw.normal(0, 1, x.shape)
    y = tiles.units_of(y - (x * y).sum(axis=1, keepdims=True) * x)
    y = 0.95 * x + math.sqrt(1 - 0.95 ** 2) * y
    met = (tiles.cells(x, bits, tables) == tiles.cells(y, bits, tables)).any(axis=1).mean()
    assert met > 0.99
