"""Vector codes from integer codebooks, with LAESA pivots in place of a full scan of the entries.

Vectors are integers, cut into equal parts with a codebook each. A few entries of each first codebook
stay its pivots for good. The distances of a vector's parts to them are computed once and stored; a
round computes those of the pivots to its entries, whose differences to the stored ones are lower
bounds (triangle inequality). A part takes the entries by rising bound, evaluates them exactly in
integers, and stops where the least bound left is above the best distance. Bounds are doubles and are
lowered by more than their rounding errors, so no entry that could win or tie is passed over.

The driver sees the entries only: their seeds, and per round the sum and count of each entry's parts.

Left out are vectors that are null or hold a null or a non-finite component; also, so that all
distances are longs, those whose integer components' squares sum to 2^60 or more, those of no component
or of a length that the number of parts does not divide, and those of another length than the smallest id's. Rows that repeat
an id are coded each; seeds take an id once, with its least vector. Rows without an id are coded and
give no seed. Labels may be null; nulls share a sum. Extra columns are left out, and an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillgrain.llm.tables import query, table
from tillgrain.session import pin

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
PIVOTS = 5
#: Squares of a vector's components sum to less, so every distance of two vectors fits a long.
MOST_SQUARES = 2.0 ** 60
#: Rows that a task adds up before it hands its sums on: components are below 2^30.
FLUSH_ROWS = 1 << 31


def integers(vectors: DataFrame, id: str, vector: str, label: str, scale: int, parts: int) -> DataFrame:
    """vec_id, label and the integer vector of the rows that take part, but for their common length."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    floors = F.transform("x", lambda x: F.floor(x * scale))
    squares = F.aggregate("x", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * scale).cast("double"), 2))
    # A double that no long holds is far beyond the largest square; it is judged before it is cast.
    small = F.forall("x", lambda x: F.abs(x) < MOST_SQUARES / scale)
    return (vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"),
                           F.col(f"`{label}`").alias("label"),
                           F.col(f"`{vector}`").cast("array<double>").alias("x"))
            .where(F.col("x").isNotNull() & (F.size("x") > 0) & (F.size("x") % parts == 0))
            .where(F.forall("x", ok)).where(small).where(squares < MOST_SQUARES)
            .select("vec_id", "label", floors.alias("v")))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(rows, -1)


def first_vectors(rows: DataFrame, count: int) -> list[list[int]]:
    """The vectors of the smallest ids. A task hands on as many ids at most."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for batch in batches:
            if not len(batch):
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            reach = np.unique(ids)[:count]
            last = reach[-1] if len(reach) == count else ids.max()
            if len(held) == count:
                last = min(last, max(held))
            for at in np.flatnonzero(ids <= last):
                own, body = int(ids[at]), tuple(batch.column(1)[int(at)].as_py())
                held[own] = min(held.get(own, body), body)
            held = dict(sorted(held.items())[:count])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.list_(pa.int64()))],
            ["vec_id", "v"])

    found = (rows.where("vec_id is not null").select("vec_id", "v")
             .mapInArrow(work, "vec_id bigint, v array<bigint>")
             .groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").limit(count))
    return [r["v"] for r in found.collect()]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of a to every row of b."""
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def spread_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries that lie far from each other: the first one, then always the farthest."""
    chosen = [0]
    far = squared(entries, entries[:1])[:, 0]
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, squared(entries, entries[chosen[-1:]])[:, 0])
    return entries[chosen]


def nearest(parts: np.ndarray, to_pivots: np.ndarray, pivots: np.ndarray, entries: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of and squared distance to each part's nearest entry, ties to the lower index, and how
    many distances were evaluated. ``to_pivots`` has the parts' squared distances to the pivots."""
    own = np.sqrt(to_pivots.astype(np.float64))
    theirs = np.sqrt(squared(pivots, entries).astype(np.float64))
    low = np.zeros((len(parts), len(entries)))
    for p in range(len(pivots)):
        a, b = own[:, p, None], theirs[None, p]
        np.maximum(low, np.abs(a - b) - (a + b) * 2.0 ** -50, out=low)
    low = low * low * (1 - 2.0 ** -48)
    best = np.full(len(parts), np.iinfo(np.int64).max)
    at = np.zeros(len(parts), np.int64)
    live, evaluated = np.arange(len(parts)), 0
    while len(live):
        entry = low.argmin(axis=1)
        bound = low[np.arange(len(low)), entry]
        go = bound <= best[live]
        live, entry, low = live[go], entry[go], low[go]
        away = ((parts[live] - entries[entry]) ** 2).sum(axis=1)
        evaluated += len(live)
        better = (away < best[live]) | ((away == best[live]) & (entry < at[live]))
        best[live[better]], at[live[better]] = away[better], entry[better]
        low[np.arange(len(low)), entry] = np.inf
    return at, best, evaluated


def _cut(vectors: np.ndarray, parts: int) -> np.ndarray:
    """By part, row, position."""
    return vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2)


def with_pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The rows with the squared distances of their parts to the part's pivots."""
    parts = len(pivots)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("v")
            if not len(batch):
                continue
            cut = _cut(_matrix(batch.column(at), len(batch)), parts)
            away = np.concatenate([squared(c, p) for c, p in zip(cut, pivots)], axis=1)
            ends = np.arange(len(batch) + 1, dtype=np.int32) * away.shape[1]
            yield batch.append_column("away", pa.ListArray.from_arrays(ends, away.ravel()))

    added = T.StructField("away", T.ArrayType(T.LongType()))
    return rows.mapInArrow(work, T.StructType([*rows.schema.fields, added]))


def _assigned(batch: pa.RecordBatch, books: np.ndarray, pivots: np.ndarray):
    """Per part: its cut, the entries taken, the errors."""
    parts = len(books)
    cut = _cut(_matrix(batch.column(batch.schema.get_field_index("v")), len(batch)), parts)
    away = _matrix(batch.column(batch.schema.get_field_index("away")), len(batch))
    away = away.reshape(len(batch), parts, -1)
    for part in range(parts):
        taken, error, _ = nearest(cut[part], away[:, part], pivots[part], books[part])
        yield cut[part], taken, error


def moved(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The codebooks after a round: the floored means of the parts that took an entry."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, seen = np.zeros((parts, entries, width + 1), np.int64), 0

        def handed() -> pa.RecordBatch:
            cells = np.flatnonzero(totals)
            return pa.RecordBatch.from_arrays(
                [pa.array(cells.astype(np.int32)), pa.array(totals.ravel()[cells])], ["cell", "total"])

        for batch in batches:
            if not len(batch):
                continue
            for part, (cut, taken, _) in enumerate(_assigned(batch, books, pivots)):
                np.add.at(totals[part, :, :width], taken, cut)
                totals[part, :, width] += np.bincount(taken, minlength=entries)
            seen += len(batch)
            if seen >= FLUSH_ROWS:
                yield handed()
                totals[:], seen = 0, 0
        yield handed()

    sums = (rows.select("v", "away").mapInArrow(work, "cell int, total bigint").groupBy("cell")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect())
    totals = np.zeros(parts * entries * (width + 1), object)
    for row in sums:
        totals[row["cell"]] = int(row["total"])
    totals = totals.reshape(parts, entries, width + 1)
    new = books.copy()
    for part, entry in np.argwhere(totals[:, :, width] > 0):
        count = totals[part, entry, width]
        new[part, entry] = [total // count for total in totals[part, entry, :width]]
    return new


def coded(rows: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """vec_id, label, code and error."""
    kind = rows.schema["label"].dataType

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            codes = np.empty((len(batch), len(books)), np.uint8)
            errors = np.zeros(len(batch), np.int64)
            for part, (_, taken, error) in enumerate(_assigned(batch, books, pivots)):
                codes[:, part] = taken
                errors += error
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in codes]),
                 pa.array(errors)], ["vec_id", "label", "code", "error"])

    schema = f"vec_id bigint, label {kind.simpleString()}, code string, error bigint"
    return rows.mapInArrow(work, schema)


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label",
             scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error and label_error of each row that takes part, and the codebooks by
    part, entry and position. At most 256 entries, since a code has a byte for each part."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = integers(vectors, id, vector, label, scale, parts)
    least = rows.where("vec_id is not null").agg(
        F.min(F.struct("vec_id", F.size("v").alias("length"))).alias("first")).first()["first"]
    schema = f"vec_id bigint, label {rows.schema['label'].dataType.simpleString()}, code string, " \
             "error bigint, label_error bigint"
    if least is None:  # no row has an id: nothing to seed the books with
        return vectors.sparkSession.createDataFrame([], schema), np.empty((parts, 0, 0), np.int64)
    rows = rows.where(F.size("v") == least["length"])
    seeds = np.array(first_vectors(rows, entries), np.int64)
    books = np.ascontiguousarray(_cut(seeds, parts))
    fixed = np.stack([spread_pivots(book, pivots) for book in books])
    ready = pin(with_pivot_distances(rows, fixed))
    for _ in range(rounds):
        books = moved(ready, books, fixed)
    made = pin(coded(ready, books, fixed))
    sums = made.groupBy(F.col("label").alias("_label")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    return (made.join(sums, F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "label", "code", "error", "label_error"), books)


#: Parts of the vectors, entries and parts' distances as rows; a round is a pair of the last two.
_ASSIGN = """
{take} AS (
  SELECT vec_id, p, min(struct_pack(d := d, e := e)) AS m FROM (
    SELECT x.vec_id, x.p, b.e, list_sum(list_transform(range(1, x.w + 1),
             lambda i: (x.c[i] - b.c[i]) * (x.c[i] - b.c[i])))::BIGINT AS d
    FROM cut x JOIN {book} b USING (p)) GROUP BY vec_id, p)"""
_MOVE = """
{new} AS (
  SELECT b.p, b.e, coalesce(g.c, b.c) AS c FROM {book} b LEFT JOIN (
    SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
      SELECT x.p, t.m.e AS e, i, sum(x.c[i])::BIGINT AS s, count(*) AS n
      FROM cut x JOIN {take} t USING (vec_id, p), range(1, (SELECT max(w) + 1 FROM cut)) r(i)
      GROUP BY x.p, t.m.e, i) GROUP BY p, e) g ON g.p = b.p AND g.e = b.e)"""
ORACLE = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (
  SELECT vec_id, p, len(v) // 16 AS w, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS c
  FROM kept, range(0, 16) r(p)),
seed AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS (SELECT p, e, c FROM cut JOIN seed USING (vec_id)),""" + ",".join(
    _ASSIGN.format(take=f"take{n}", book=f"book{n}")
    + ("," + _MOVE.format(new=f"book{n + 1}", book=f"book{n}", take=f"take{n}") if n < ROUNDS else "")
    for n in range(ROUNDS + 1)) + f""",
told AS (
  SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error
  FROM take{ROUNDS} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{ROUNDS})
    AS codebooks_sha256
FROM told JOIN kept USING (vec_id)"""


@query("op11_laesa_codes", ORACLE)
def op11_laesa_codes(spark: SparkSession, folder: str) -> DataFrame:
    rows, books = compress(table(spark, folder, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error",
                       F.lit(digest(books)).alias("codebooks_sha256"))
