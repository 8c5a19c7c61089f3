"""Jaccard join, components, shards, top-k and archives against brute force."""

import gzip
import hashlib
import random
from collections import Counter, defaultdict
from math import isqrt

import numpy as np
import pytest

from tillgrain.llm import jaccard, maxscore, sharding, warc
from tillgrain.llm.components import components
from tillgrain.session import scratch_path


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        words = (text or "").split()
        step = min(width, len(words))
        sets[i] = {tuple(words[k:k + step]) for k in range(len(words) - step + 1)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    draw = random.Random(seed)
    words = [f"w{n}" for n in range(400)]
    rows = []
    for _ in range(12):
        text = draw.choices(words, k=draw.choice([1, 3, 5, 8, 40, 90, 150]))
        rows.append(text)
        for _ in range(draw.randint(0, 8)):
            copy = list(draw.choice(rows[-3:]))
            for _ in range(draw.randint(0, max(1, len(copy) // 30))):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append(copy + draw.choices(words, k=draw.randint(0, 2)))
    texts = [" ".join(r) for r in rows] + ["", None, "same one", "same one", " \t\n"]
    ids = draw.sample(range(1000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("width,percent,seed,tile", [(4, 85, 1, 4096), (5, 80, 2, 3), (2, 60, 3, 2)])
def test_components_of_near_copies(documents, width, percent, seed, tile):
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard.link(documents(rows), width, percent, tile=tile).collect()}
    assert got == brute(rows, width, percent)


def test_links_that_the_smallest_id_has_no_part_in(documents):
    """Copies of a text that only it links, with the text itself under the largest id."""
    draw = random.Random(4)
    base = [f"b{n}" for n in range(120)]
    rows = []
    for n in range(25):
        copy = list(base)
        for at in draw.sample(range(120), 3):
            copy[at] = f"x{n}-{at}"
        rows.append((n, " ".join(copy)))
    rows.append((99, " ".join(base)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in jaccard.link(documents(rows), 4, 80, tile=6).collect()}
    assert got == brute(rows, 4, 80)


def test_odd_rows_of_the_jaccard_join(documents):
    rows = [(5, "a b c d e f"), (None, "a b c d e f"), (3, "A B C D E F"), (5, "q r s t u v"),
            (9, "q r s t u v"), (None, None)]
    got = sorted(((r["doc_id"], r["component_id"]) for r in
                  jaccard.link(documents(rows)).collect()), key=str)
    assert [c for d, c in got if d is not None] == [3, 3, 3, 3]
    assert jaccard.link(documents([])).count() == 0
    left = jaccard.without_near_copies(documents(rows + [(3, "A B C D E F")]), 4, 85)
    assert Counter(r["doc_id"] for r in left.collect()) == {3: 1, None: 2}
    assert left.columns == documents([]).columns


def test_the_tree_finds_all_pairs_that_the_bound_leaves():
    draw = np.random.default_rng(1)
    law = jaccard.Law(70)
    for _ in range(20):
        centres = draw.poisson(2, (5, 16))
        points = np.maximum(0, centres[draw.integers(0, 5, 60)] + draw.integers(-1, 2, (60, 16)))
        sizes, labels = points.sum(axis=1), draw.integers(0, 8, 60)
        want = {(i, j) for i in range(60) for j in range(i + 1, 60) if labels[i] != labels[j]
                and np.minimum(points[i], points[j]).sum() >= law.least(sizes[i], sizes[j])}
        found = jaccard.RTree(points, sizes, labels).pairs(law)
        assert {tuple(sorted(p)) for p in found.tolist()} == want


@pytest.mark.parametrize("size,most", [(1, 0), (4, 0), (5, 0), (6, 300), (10, 300)])
def test_small_different_sets_hardly_meet(size, most):
    draw = np.random.default_rng(7)
    met = Counter(key for _ in range(3000) for key in jaccard.range_keys(
        np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64)), 85).tolist())
    assert sum(n * (n - 1) // 2 for n in met.values()) <= most


def test_small_sets_that_link_meet():
    draw = np.random.default_rng(8)
    for percent in (50, 80, 85):
        law = jaccard.Law(percent)
        for _ in range(1500):
            a = draw.integers(0, 1 << 64, draw.integers(1, 40), dtype=np.uint64)
            b = np.append(a[draw.integers(0, 4):], draw.integers(0, 1 << 64, draw.integers(0, 4),
                                                                dtype=np.uint64))
            a, b = np.unique(a), np.unique(b)
            if len(b) and not np.array_equal(a, b) \
                    and len(np.intersect1d(a, b)) >= law.least(len(a), len(b)):
                assert len(np.intersect1d(jaccard.range_keys(a, percent),
                                          jaccard.range_keys(b, percent)))


@pytest.mark.parametrize("apart", [1, 25])
def test_members_of_the_largest_component_are_not_paired(spark, apart):
    """One range with a component of 200 members and others, in tiles of 10."""
    members = 200 + apart
    shared = spark.createDataFrame([(5, n, 20, members + 1, 0, 20) for n in range(1, members + 1)],
                                   "key bigint, rep bigint, size int, members bigint, least bigint, "
                                   "least_size int")
    roots = spark.createDataFrame([(n, 1) for n in range(1, 201)], "node bigint, root bigint")
    points = shared.select("rep", "size").withColumnRenamed("size", "point")
    tiles = defaultdict(list)
    for r in jaccard._open_rows(shared, roots, points, 10).collect():
        tiles[r["part_a"], r["part_b"]].append((r["rep"], r["part"]))
    pairs = {tuple(sorted((u, v))) for (a, b), rows in tiles.items() for u, p in rows for v, q in rows
             if u != v and (a == b or p != q)}
    assert pairs >= {(u, v) for v in range(201, members + 1) for u in range(1, v)}
    assert not any(u <= 200 and v <= 200 for u, v in pairs)
    copies = -(-(apart + 1) // 10)
    assert sum(map(len, tiles.values())) <= 200 * copies + apart * (20 + copies)


def test_components_of_a_graph(spark):
    draw = random.Random(6)
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)]
    edges += [(n, n + 1) for n in range(300, 340)] + [(500, 500), (7, None)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    near = defaultdict(set)
    for u, v in edges:
        if v is not None:
            near[u].add(v)
            near[v].add(u)
    for start in near:
        seen, todo = {start}, [start]
        while todo:
            for n in near[todo.pop()] - seen:
                seen.add(n)
                todo.append(n)
        assert got.get(start, start) == min(seen)


def test_shards_are_even_and_keep_equal_texts_together(documents):
    draw = random.Random(7)
    texts = ["x" * draw.randint(0, 300) for _ in range(300)] + ["big" * 2000] * 5 + [None, None, "é"]
    rows = list(enumerate(texts))
    rows += [(0, texts[0]), (None, "loose")]
    got = sharding.shard_by_bytes(documents(rows), shards=5, bins=64, cells=4).collect()
    assert len(got) == len(rows)
    where, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        text = "loose" if r["doc_id"] is None else texts[r["doc_id"]]
        where[text].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        assert r["size"] == len((text or "").encode()) + 8
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    others = sorted(loads[s] for s in range(5))[:-1]
    assert others[-1] - others[0] < 0.2 * others[-1]
    assert sharding.shard_by_bytes(documents([])).count() == 0


def test_the_schedule_takes_the_largest_first():
    assert sharding.schedule([(1, 5), (2, 4), (3, 3), (4, 3), (5, 3)], 2) == {
        1: 0, 2: 1, 3: 1, 4: 0, 5: 1}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("shard_rows,block", [(8192, 2048), (7, 3)])
def test_top_k_is_exact(spark, shard_rows, block):
    draw = np.random.default_rng(2)
    values = np.round(draw.normal(0, 0.2, (150, 12)), 2).astype(np.float32)
    values[40:60] = values[0]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(values)]
    odd = [(200, None, 1), (201, [1.0, None] + [0.0] * 10, 1), (202, [float("nan")] * 12, 1),
           (203, [float("inf")] * 12, 1), (204, [3e38] * 12, 1), (None, [0.5] * 12, 1)]
    ready = maxscore.integers(vectors(spark, rows + odd))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in maxscore.top_k(
        ready, ready.where("vec_id % 25 = 0"), 10, shard_rows, block).collect()}
    whole = np.floor(values.astype(np.float64) * 1024).astype(int)
    want = {}
    for q in range(0, 150, 25):
        scores = whole @ whole[q]
        order = [i for i in sorted(range(150), key=lambda i: (-scores[i], i)) if i != q][:10]
        want |= {(q, n + 1): (i, scores[i]) for n, i in enumerate(order)}
    assert got == want


@pytest.mark.parametrize("shard_rows,block", [(8192, 2048), (9, 2)])
def test_top_k_of_repeated_queries_and_large_components(spark, shard_rows, block):
    draw = random.Random(12)
    side = isqrt((2**63 - 1) // 2) / 1024  # two of them stay just within a long
    rows = [(n, [draw.uniform(-2, 2) for _ in range(4)]) for n in range(60)]
    rows += [rows[0], rows[0], (10, [1.5, -1.0, 0.25, 0.0]), (10, [-0.5, 2.0, 1.0, 1.0]), rows[10]]
    rows += [(70 + n, [draw.choice([-1, 1]) * draw.uniform(16_384, 1e6) for _ in range(4)])
             for n in range(20)]
    rows += [(80, rows[-1][1]), (101, [side, side]), (102, [-side, side]), (103, [side, -side, 0.5, 0.0]),
             (110, [side, side]), (120, [side, side, 128.0]), (121, [0.0, 2966136.0]), (122, [1e300])]
    whole = [(i, [int(np.floor(x * 1024)) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    whole = [(i, v) for i, v in whole if sum(x * x for x in v) < 2**63]
    assert not {120, 121, 122} & {i for i, _ in whole} and {101, 102, 103} <= {i for i, _ in whole}
    want = Counter()
    for q, a in whole:
        if q % 10 == 0:
            hits = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q)[:10]
            want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(hits))
    ready = maxscore.integers(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = maxscore.top_k(ready, ready.where("vec_id % 10 = 0"), 10, shard_rows, block)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(map(tuple, got.collect())) == want


def test_top_k_of_few_rows(spark):
    ready = maxscore.integers(vectors(spark, [(0, [1.0], 1), (3, [-2.0], 1)]))
    got = maxscore.top_k(ready, ready.where("vec_id = 0")).collect()
    assert [(r["vec_id"], r["score"]) for r in got] == [(3, -2048 * 1024)]
    none = maxscore.integers(vectors(spark, []))
    assert maxscore.top_k(none, none).count() == 0


def test_archives_round_trip(spark):
    long = "<p>" + "é" * 600
    rows = [(1, "u1", long), (7, "u\r\nx", long), (4, None, long), (2, "u2", "short"),
            (3, "u3", "short"), (5, "u5", None), (6, "u6", ""), (None, "u", long), (7, "u7", long),
            (8, "u8", "y\r\n\r\n" * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    dumps, out = scratch_path(spark, "dumps"), scratch_path(spark, "archives")
    warc.write_monolithic(warc.plan_records(pages), dumps, per_file=3)
    warc.normalise(spark, dumps, out)
    got = warc.read_records(spark, out).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next((h or "") for i, _, h in rows if i == r["page_id"]).encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(text), hashlib.sha1(text).hexdigest())
        revisit = text == long.encode() and r["page_id"] != 7
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (7 if revisit else None)
        assert bytes(r["payload"]) == (b"" if revisit else text)
    index = {(r["archive"], r["offset"], r["length"], r["record_type"], r["page_id"])
             for r in warc.read_index(spark, out).collect()}
    assert index == {(r["archive"], r["offset"], r["length"], r["record_type"], r["page_id"])
                     for r in got}
    for path, content in spark.read.format("binaryFile").load(f"{out}/kind=warc/*/*").select(
            "path", "content").collect():
        archive = path.rsplit("archive=", 1)[1].split("/")[0]
        assert gzip.decompress(content).startswith(b"WARC/1.1")
        for name, offset, length, *_ in index:
            if name == archive:
                assert gzip.decompress(content[offset:offset + length]).startswith(b"WARC/1.1\r\n")


def test_archives_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    dumps, out = scratch_path(spark, "dumps"), scratch_path(spark, "archives")
    warc.write_monolithic(warc.plan_records(pages), dumps)
    warc.normalise(spark, dumps, out)
    assert warc.read_records(spark, out).count() == 0


def test_a_stream_cut_short_is_told():
    whole = gzip.compress(b"WARC/1.1\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n")
    assert list(warc.split_records(whole + whole)) == [gzip.decompress(whole)] * 2
    with pytest.raises(ValueError):
        list(warc.split_records(whole[:-9]))
