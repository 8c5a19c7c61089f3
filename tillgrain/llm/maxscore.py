"""Exact top-k by integer inner product, with MaxScore over signed dimensions.

A component is floor(1024 x). Each dimension gives two posting lists, of the vectors where it is
above and where it is below zero; a query term is a list whose sign makes its product positive. A
vector's score is at most the sum of its positive products, so a vector found in no essential list
cannot reach the k-th best score so far. Vectors are split into shards of bounded size, queries are
dealt in blocks of bounded size, each shard gives its k best of every query and the shards' lists are
merged.

Vectors that are null, hold a null or a non-finite component, or are so long that scores leave the
range of a long (their sum of squares does) take no part; vectors of other lengths than a query's count
as padded with zeros. A candidate is every row with another id than the query's; rows that repeat an id
are ranked each. Every query row has a list of its own, also where rows repeat an id. Rows with a null id are no queries and no candidates. Extra columns are left out; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tillgrain.llm.tables import query, table
from tillgrain.session import pin

SCALE = 1024
#: Largest sum of squares that takes part: no score of two such vectors, and no part of it, is larger.
MOST = (1 << 63) - 1
#: Bounds that add up to more are not used, since their sums could leave a long.
MOST_BOUND = 1 << 62
#: Vectors of one shard, which one task holds as integers, and queries of one block.
SHARD_ROWS = 8_192
BLOCK_QUERIES = 2_048
HIT = "query bigint, query_id bigint, times int, vec_id bigint, score bigint"


def integers(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """Ids and integer vectors of the rows that take part."""
    value = F.col(f"`{vector}`").cast("array<double>")
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def squares(kind: str, of: str) -> Column:
        zero = F.lit(0).cast(kind)
        return F.aggregate("v", zero, lambda s, x: (s + x.cast(of) * x.cast(of)).cast(kind))

    # Near the end of the range doubles are too coarse, so decimals decide.
    rough = squares("double", "double")
    fits = (F.when(rough < 2.0 ** 62, True).when(rough > 2.0 ** 64, False)
            .otherwise(squares("decimal(38,0)", "decimal(19,0)") <= F.lit(MOST)))
    return (vectors.select(F.col(f"`{id}`").cast("long").alias("vec_id"), value.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", ok))
            .select("vec_id", F.transform("v", lambda x: F.floor(x * scale).cast("long"))
                    .alias("v"))
            .where(fits))


class Shard:
    """Postings of a bounded number of vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, np.ascontiguousarray(rows)
        self.columns = np.ascontiguousarray(rows.T)
        dims = len(self.columns)
        self.lists = {}
        self.best = np.zeros((2, dims), np.int64)
        for d, column in enumerate(self.columns):
            for sign, at in ((0, np.flatnonzero(column > 0)), (1, np.flatnonzero(column < 0))):
                if len(at):
                    self.lists[d, sign] = at
                    self.best[sign, d] = np.abs(column[at]).max()

    def search(self, query_id: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best, ties to smaller ids."""
        dims = np.arange(len(q))
        bounds = np.abs(q) * self.best[(q < 0).astype(int), dims]
        order = np.argsort(bounds, kind="stable")
        rising = np.cumsum(bounds[order])
        own = self.ids == query_id
        # A first threshold: the exact scores of vectors that the strongest terms favour.
        strongest = [self.lists[d, int(q[d] < 0)] for d in order[::-1][:2]
                     if (d, int(q[d] < 0)) in self.lists]
        floor = None
        if strongest and bounds.astype(float).sum() <= MOST_BOUND:
            column = order[-1]
            some = strongest[0]
            if len(some) > 4 * k:
                impact = np.abs(self.columns[column][some])
                some = some[np.argpartition(impact, len(some) - 4 * k)[-4 * k:]]
            some = some[~own[some]]
            if len(some) >= k:
                floor = np.partition(self.rows[some] @ q, len(some) - k)[len(some) - k]
        # Terms whose bounds together stay below the threshold cannot carry a vector alone.
        split = 0 if floor is None else int(np.searchsorted(rising, floor, "left"))
        if floor is None or floor <= 0:
            found = ~own
        else:
            found = np.zeros(len(self.ids), bool)
            for d in order[split:]:
                hits = self.lists.get((d, int(q[d] < 0)))
                if hits is not None:
                    found[hits] = True
            found &= ~own
        at = np.flatnonzero(found)
        scores = np.zeros(len(at), np.int64)
        # Probe the dimensions, strongest first, while the rest can still lift a vector.
        step = max(1, len(order) // 8)
        for begin in range(len(order), 0, -step):
            now = order[max(0, begin - step):begin]
            scores += self.rows[np.ix_(at, now)] @ q[now]
            left = rising[begin - step - 1] if begin - step > 0 else 0
            if floor is not None and left:
                stay = scores + left >= floor
                at, scores = at[stay], scores[stay]
        top = np.lexsort((self.ids[at], -scores))[:k]
        return at[top], scores[top]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
          block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The k best rows of ``vectors`` for each row of ``queries``; both as from ``integers``."""
    spark = vectors.sparkSession
    # Equal rows are searched once.
    single = pin(queries.groupBy("vec_id", "v").agg(F.count(F.lit(1)).cast("int").alias("times")))
    asked = single.count()
    blocks = max(1, -(-asked // block_queries))
    numbered = single.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
    parts, done = [], 0
    for block in range(blocks):
        ours = numbered.where(F.col("block") == block).orderBy("vec_id", "v").collect()
        if ours:
            parts.append(_block_hits(vectors, [
                (done + n, r["vec_id"], r["times"], r["v"]) for n, r in enumerate(ours)],
                k, shard_rows))
            done += len(ours)
            if blocks > 1:  # one pass each, kept so that the plan doesn't grow
                parts[-1] = pin(parts[-1])
    hits = parts[0] if parts else spark.createDataFrame([], HIT)
    for part in parts[1:]:
        hits = hits.unionAll(part)
    rank = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .withColumn("time", F.explode(F.sequence(F.lit(1), "times")))
            .select("query_id", "rank", "vec_id", "score"))


def _block_hits(vectors: DataFrame, asked: list, k: int, shard_rows: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(
        [(n, i, times, np.array(v, np.int64)) for n, i, times, v in asked])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = [], []

        def answer() -> pa.RecordBatch:
            wanted = shared.value
            width = max(max(map(len, rows)), max(len(v) for *_, v in wanted))
            pad = lambda v: v if len(v) == width else np.pad(v, (0, width - len(v)))
            shard = Shard(np.array(ids, np.int64), np.array([pad(v) for v in rows], np.int64))
            made = [shard.search(i, pad(v), k) for _, i, _, v in wanted]
            sizes = [len(a) for a, _ in made]
            return pa.RecordBatch.from_pydict({
                "query": np.repeat(np.array([n for n, *_ in wanted], np.int64), sizes),
                "query_id": np.repeat(np.array([i for _, i, *_ in wanted], np.int64), sizes),
                "times": np.repeat(np.array([t for _, _, t, _ in wanted], np.int32), sizes),
                "vec_id": shard.ids[np.concatenate([a for a, _ in made])],
                "score": np.concatenate([s for _, s in made])})

        for batch in batches:
            ids += batch.column(0).to_pylist()
            rows += [np.asarray(x.values, np.int64) for x in batch.column(1)]
            while len(ids) >= shard_rows:
                spare = ids[shard_rows:], rows[shard_rows:]
                del ids[shard_rows:], rows[shard_rows:]
                yield answer()
                ids, rows = spare
        if ids:
            yield answer()

    return vectors.select("vec_id", "v").mapInArrow(search, HIT)


@query("op7_maxscore")
def op7_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    # Vectors come in few files: spread them, so that each task holds one shard.
    vectors = integers(table(spark, folder, "embeddings"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ready = pin(vectors.repartition(parts, "vec_id"))
    return top_k(ready, ready.where("vec_id % 100 = 0"))
