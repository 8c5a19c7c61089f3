"""Near-duplicate vectors by quantised tile products, inside the cells of random rotations.

* Equal vectors become one class with a weight; only classes go on.
* A cell is named by the largest coordinates, with their signs, of a few random rotations
  (cross-polytope hashing). Cells get finer with the number of classes, so that one holds about
  ``CELL_ROWS``; how many tables of cells are needed follows from their collision rate at just the
  threshold, measured on random pairs: of pairs there, all tables together miss a share of about
  ``MISSED``, of closer ones less. With few classes there is one cell, and nothing is missed.
* A cell is compared as a matrix product of its quantised vectors. A unit vector u is held as s q + e
  with int8 steps q, so u.v is off from s s' q.q' by |e| + (1 + |e|) |e'| at most: above the threshold by
  more than that is a link, below by more is none, and only what lies between is computed in doubles.
  The products of int8 steps are exact integers, also in the floating type that multiplies them.
* A pair counts in the first table where it shares a cell. A tile hands on a count for each vector and
  a spanning forest of its links, so rows grow with its sides and not with its links.
* Cells over ``TILE`` classes are dealt out in pairs of parts. Before that, members within half the
  threshold's angle of the cell's leader, its smallest class, become a group: all of them link with each
  other, so they are counted by their weight, and only the others of the cell are compared with all.

Vectors that are null, empty, zero, or hold a null or a non-finite component link with nothing, and
vectors of different lengths don't link. Every row is a vector of its own, and rows with one id are
counted each and are one node in components. Rows without an id link with nothing and have no
component; a row that links with nothing is a component of its own. Extra columns are left out, and
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillgrain.llm.components import components
from tillgrain.llm.tables import query, table
from tillgrain.session import pin

THRESHOLD = 0.95
CELL_ROWS = 512
TILE = 2_048
MISSED = 0.001
STEPS = 127
#: More than the rounding errors of a product of unit vectors in doubles.
SLACK = 1e-9
#: Bits of a cell's number that one rotation gives at most.
MOST_BITS = 7
MIX = np.uint64(0x9E3779B97F4A7C15)


def stored(v: np.ndarray) -> bytes:
    """Equal vectors give equal bytes; components that fit floats are stored as such."""
    v = v + 0.0  # a negative zero equals zero
    with np.errstate(over="ignore"):
        short = v.astype(np.float32)
    return short.tobytes() if (short.astype(np.float64) == v).all() else v.tobytes()


def vector_of(body: bytes, length: int) -> np.ndarray:
    return np.frombuffer(body, np.float32 if len(body) == 4 * length else np.float64).astype(np.float64)


def units_of(vectors: np.ndarray) -> np.ndarray:
    """The rows at length one; scaled first, so that their squares stay in range."""
    near = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return near / np.sqrt((near * near).sum(axis=1, keepdims=True))


def prepared(vectors: DataFrame, id: str, vector: str) -> DataFrame:
    """Per row its id and, if it can link, a mark that equal vectors share, and the vector."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks, lengths, bodies = [], [], []
            for x in batch.column(1):
                v = x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0)
                if len(v) and np.isfinite(v).all() and v.any():
                    bodies.append(stored(v))
                    lengths.append(len(v))
                    marks.append(xxhash.xxh3_128_digest(bodies[-1] + len(v).to_bytes(8, "little")))
                else:
                    for column in (marks, lengths, bodies):
                        column.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(marks, pa.binary()), pa.array(lengths, pa.int32()),
                 pa.array(bodies, pa.binary())], ["vec_id", "mark", "length", "vector"])

    return vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"),
                          F.col(f"`{vector}`").cast("array<double>").alias("v")).mapInArrow(
        work, "vec_id bigint, mark binary, length int, vector binary")


# ---- cells

@lru_cache(maxsize=8)
def rotations(length: int, bits: tuple[int, ...], tables: int) -> list[list[np.ndarray]]:
    """Orthonormal rows by table and rotation; a rotation of b bits has 2^(b-1) of them."""
    draw = np.random.default_rng(20250107)

    def one(count: int) -> np.ndarray:
        turned, upper = np.linalg.qr(draw.standard_normal((length, count)))
        return (turned * np.sign(np.diag(upper))).T

    return [[one(1 << (b - 1)) for b in bits] for _ in range(tables)]


def bits_of(classes: int, length: int, cell_rows: int) -> tuple[int, ...]:
    """Bits of each rotation, so that cells hold about so many classes."""
    left = ceil(log(classes / cell_rows, 2)) if classes > cell_rows else 0
    most = min(length.bit_length(), MOST_BITS)  # 2^(most-1) <= length
    bits = []
    while left > 0:
        bits.append(min(left, most))
        left -= bits[-1]
    return tuple(bits)


def cells(units: np.ndarray, bits: tuple[int, ...], tables: int) -> np.ndarray:
    """A cell's number by row and table."""
    made = np.zeros((len(units), tables), np.uint64)
    for at, rotated in enumerate(rotations(units.shape[1], bits, tables)):
        for matrix in rotated:
            turned = units @ matrix.T
            place = np.abs(turned).argmax(axis=1)
            below = turned[np.arange(len(units)), place] < 0
            made[:, at] = made[:, at] * MIX + (place * 2 + below + 1).astype(np.uint64)
    return made.view(np.int64)


@lru_cache(maxsize=64)
def tables_for(length: int, bits: tuple[int, ...], threshold: float, missed: float) -> int:
    """So many tables that of pairs at the threshold a share of about ``missed`` meets in none, by the
    share of random pairs at that angle that meet in one."""
    if not bits:
        return 1
    draw = np.random.default_rng(20250108)
    pairs, trials = 400, 16
    x = draw.standard_normal((pairs, length))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.standard_normal((pairs, length))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    y = threshold * x + sqrt(1 - threshold ** 2) * y
    met = min(max((cells(x, bits, trials) == cells(y, bits, trials)).mean(), 1e-6), 1 - 1e-6)
    return max(1, ceil(log(missed) / log(1 - met)))


# ---- quantised products

def quantised(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 steps, their size, and a bound on the length of what they leave out."""
    scale = np.abs(units).max(axis=1) / STEPS
    steps = np.rint(units / scale[:, None]).astype(np.int8)
    rest = units - scale[:, None] * steps
    return steps, scale, np.sqrt((rest * rest).sum(axis=1)) * (1 + SLACK) + SLACK


def multiplied(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows. Sums of so many steps are exact in floats, of more in doubles."""
    kind = np.float32 if a.shape[1] * (STEPS + 1) ** 2 < 1 << 24 else np.float64
    return a.astype(kind) @ b.astype(kind).T


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row in doubles."""
    a, b = (x / np.abs(x).max(axis=1, keepdims=True) for x in (a, b))
    dot = lambda x, y: np.einsum("ij,ij->i", x, y)
    return dot(a, b) / (np.sqrt(dot(a, a)) * np.sqrt(dot(b, b)))


class Side:
    """The vectors of a tile's side, and their steps."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.steps, self.scale, self.rest = quantised(units_of(vectors))


def links(a: Side, b: Side, threshold: float, rows: int = 256
          ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places in a and in b of the pairs that reach the threshold, some rows of a at a time, and how
    many pairs were computed in doubles."""
    for begin in range(0, len(a.scale), rows):
        part = slice(begin, begin + rows)
        near = multiplied(a.steps[part], b.steps) * (a.scale[part, None] * b.scale[None, :])
        off = a.rest[part, None] + (1 + a.rest[part, None]) * b.rest[None, :] + SLACK
        i, j = np.nonzero(near + off >= threshold)
        sure = (near[i, j] - off[i, j]) >= threshold
        open_ = np.flatnonzero(~sure)
        for at in range(0, len(open_), 1 << 15):
            some = open_[at:at + (1 << 15)]
            sure[some] = cosine(a.vectors[i[some] + begin], b.vectors[j[some]]) >= threshold
        yield i[sure] + begin, j[sure], len(open_)


def joined(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Lower the labels to the smallest place that the links reach."""
    while len(u):
        before = label.copy()
        low = np.minimum(label[u], label[v])
        for end in (u, v):
            np.minimum.at(label, end, low)
            np.minimum.at(label, before[end], low)
        label[:] = label[label]
        if (label == before).all():
            return


def tile_links(rows: DataFrame, threshold: float) -> DataFrame:
    """Per tile and class the weight of the classes linked there, and the smallest one reached."""
    def solve(turn: int, apart: bool, held: list[tuple]) -> pa.RecordBatch | None:
        part, node, weight, home = (np.array(c, np.int64) for c in list(zip(*held))[:4])
        first = np.flatnonzero(part == part[0])
        second = np.flatnonzero(part != part[0]) if apart else first
        if not len(second):
            return None
        keys, length, body = list(zip(*held))[4:]
        earlier = np.stack([np.frombuffer(k, np.int64)[:turn] for k in keys])
        vectors = np.stack([vector_of(x, n) for x, n in zip(body, length)])
        a = Side(vectors[first])
        b = Side(vectors[second]) if apart else a
        sums, label = np.zeros(len(node), np.int64), np.arange(len(node))
        for i, j, _ in links(a, b, threshold):
            u, v = first[i], second[j]
            ok = (home[u] != home[v]) & (apart | (u < v))
            u, v = u[ok], v[ok]
            if turn:
                new = np.concatenate([np.empty(0, bool)] + [
                    ~(earlier[u[at:at + (1 << 14)]] == earlier[v[at:at + (1 << 14)]]).any(axis=1)
                    for at in range(0, len(u), 1 << 14)])
                u, v = u[new], v[new]
            np.add.at(sums, u, weight[v])
            np.add.at(sums, v, weight[u])
            joined(label, u, v)
        met = np.flatnonzero(sums)
        return pa.RecordBatch.from_arrays(
            [pa.array(node[met]), pa.array(sums[met]), pa.array(node[label[met]])],
            ["node", "links", "reached"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        tile = None

        def close() -> pa.RecordBatch | None:
            return solve(tile[0], tile[2] != tile[3], held) if len(held) > 1 else None

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(batch.num_columns)]
            for here, row in zip(zip(*columns[:4]), zip(*columns[4:])):
                if here != tile:
                    if (made := close()) is not None:
                        yield made
                    held, tile = [], here
                held.append(row)
        if (made := close()) is not None:
            yield made

    tile = ["table", "cell", "part_a", "part_b"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.select(*tile, "part", "node", "weight", "home", "cells", "length", "vector")
            .repartition(parts, *tile).sortWithinPartitions(*tile, "node")
            .mapInArrow(work, "node bigint, links bigint, reached bigint"))


# ---- the join

def _with_cells(classes: DataFrame, bits: dict[int, tuple], tables: dict[int, int]) -> DataFrame:
    """The classes with the numbers of their cells, packed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.array(batch.column("length").to_pylist(), np.int64)
            bodies = batch.column("vector").to_pylist()
            packed: list = [None] * len(batch)
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                units = units_of(np.stack([vector_of(bodies[n], length) for n in at]))
                for n, own in zip(at, cells(units, bits[length], tables[length])):
                    packed[n] = own.tobytes()
            yield batch.append_column("cells", pa.array(packed, pa.binary()))

    return classes.mapInArrow(work, T.StructType(
        [*classes.schema.fields, T.StructField("cells", T.BinaryType())]))


def _placed(nodes: DataFrame) -> DataFrame:
    """A row for each class and table. Lengths have cells of their own."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, weight, length, keys = (c.to_pylist() for c in batch.columns)
            if not node:
                continue
            own = [np.frombuffer(k, np.uint64) for k in keys]
            count = [len(k) for k in own]
            cell = np.concatenate(own) * MIX + np.repeat(np.array(length, np.uint64), count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in count])),
                 pa.array(cell.view(np.int64)), pa.array(np.repeat(np.array(node, np.int64), count)),
                 pa.array(np.repeat(np.array(weight, np.int64), count))],
                ["table", "cell", "node", "weight"])

    return nodes.select("node", "weight", "length", "cells").mapInArrow(
        work, "table int, cell bigint, node bigint, weight bigint")


def _homes(large: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """node and home: the smallest leader of a large cell within half the threshold's angle."""
    near = sqrt((1 + threshold) / 2) + SLACK

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [bool(cosine(vector_of(a, n)[None], vector_of(b, n)[None])[0] >= near)
                    for n, a, b in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["node", "home"]).filter(
                pa.array(keep, pa.bool_()))

    leaders = (large.select("leader").distinct()
               .join(nodes.select(F.col("node").alias("leader"), F.col("vector").alias("middle")),
                     "leader"))
    return (large.select("node", "leader").distinct()
            .join(nodes.select("node", "length", "vector"), "node").join(leaders, "leader")
            .select("node", "leader", "length", "vector", "middle")
            .mapInArrow(work, "node bigint, home bigint")
            .groupBy("node").agg(F.min("home").alias("home")))


def _tiles(shared: DataFrame, homes: DataFrame, tile: int) -> DataFrame:
    """Members of the cells with the parts that they meet. In a large cell the largest group is inside;
    a tile is a pair of parts of which one at least is outside."""
    known = shared.join(homes, "node", "left")
    largest = (known.where((F.col("members") > tile) & F.col("home").isNotNull())
               .groupBy("table", "cell", "home").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("table", "cell").agg(F.max(F.struct("n", "home")).alias("top")))
    rows = known.join(largest, ["table", "cell"], "left")
    inside = F.coalesce(F.col("home") == F.col("top.home"), F.lit(False))
    parts = lambda n: F.ceil(n / tile).cast("int")
    held = F.coalesce("top.n", F.lit(0))
    outer, inner = parts(F.col("members") - held), parts(held)
    dealt = lambda n: F.pmod(F.xxhash64("node"), F.greatest(n, F.lit(1))).cast("int")
    last = F.when(inside, outer).otherwise(outer + inner) - 1
    return (rows.withColumn("part", F.when(inside, outer + dealt(inner)).otherwise(dealt(outer)))
            .where(last >= 0).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            # Classes without a group are each one of their own.
            .select("table", "cell", F.least("part", "other").alias("part_a"),
                    F.greatest("part", "other").alias("part_b"), "part", "node", "weight",
                    F.coalesce("home", -F.col("node") - 1).alias("home")))


def link(vectors: DataFrame, threshold: float = THRESHOLD, id: str = "vec_id",
         vector: str = "embedding", cell_rows: int = CELL_ROWS, tile: int = TILE,
         missed: float = MISSED) -> DataFrame:
    """Per row its id, how many other rows it links with, and the smallest id that links reach."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold lies between 0 and 1")
    base = pin(prepared(vectors, id, vector))
    full = base.where("vec_id is not null and mark is not null")
    # How fine the cells are follows from how many classes there are of each length, about.
    counts = {r["length"]: r["n"] for r in full.groupBy("length").agg(
        F.approx_count_distinct("mark").alias("n")).collect()}
    bits = {length: bits_of(n, length, cell_rows) for length, n in counts.items()}
    tables = {length: tables_for(length, b, threshold, missed) for length, b in bits.items()}
    classes = (full.groupBy("mark").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"),
        F.any_value("length").alias("length"), F.any_value("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id()))
    nodes = pin(_with_cells(classes, bits, tables))
    placed = _placed(nodes)
    known = placed.groupBy("table", "cell").agg(
        F.count(F.lit(1)).alias("members"), F.min("node").alias("leader")).where("members > 1")
    shared = pin(placed.join(known, ["table", "cell"]))
    homes = pin(_homes(shared.where(F.col("members") > tile), nodes, threshold))
    rows = _tiles(shared, homes, tile).join(nodes.select("node", "length", "vector", "cells"), "node")
    found = pin(tile_links(rows, threshold))

    weights = nodes.select("node", "weight")
    grouped = homes.join(weights, "node")
    of_group = grouped.groupBy("home").agg(F.sum("weight").alias("all"))
    inside = grouped.join(of_group, "home").select("node", (F.col("all") - F.col("weight")).alias("links"))
    totals = (found.select("node", "links").unionAll(inside)
              .groupBy("node").agg(F.sum("links").alias("links")))
    own = (nodes.select("node", "mark", "weight").join(totals, "node", "left")
           .select("mark", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))

    reps = nodes.select("node", "rep")
    between = found.select("node", "reached").unionAll(homes.toDF("node", "reached"))
    edges = (between.where("node != reached").join(reps, "node")
             .join(reps.toDF("reached", "v"), "reached").select(F.col("rep").alias("u"), "v"))
    # Copies, and ids of several classes, are tied by their ids.
    copies = (full.select("vec_id", "mark").join(nodes.select("mark", "rep"), "mark")
              .where("vec_id != rep").select(F.col("vec_id").alias("u"), F.col("rep").alias("v")))
    roots = components(edges.unionAll(copies)).withColumnRenamed("node", "vec_id")
    return (base.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("mark")).alias("mark"))
            .join(own, "mark", "left").join(roots, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("root", "vec_id").alias("component_id")))


ORACLE = f"""
WITH RECURSIVE able AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
linked AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reached AS (
  SELECT vec_id, vec_id AS other FROM embeddings
  UNION SELECT r.vec_id, l.v FROM reached r JOIN linked l ON l.u = r.other)
SELECT r.vec_id, (SELECT count(*) FROM linked WHERE u = r.vec_id) AS n_links,
  min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reached r GROUP BY r.vec_id"""


@query("op12_quantised_tiles", ORACLE)
def op12_quantised_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return link(table(spark, folder, "embeddings")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
