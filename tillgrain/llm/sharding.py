"""Sharding by longest processing time: groups of equal texts stay together, the largest goes first,
each to the shard that is least loaded so far.

Groups are found by a digest of the text. Those that are large against an even share are scheduled
one by one; the many small ones are first put together by digest into a fixed number of bins, and the
bins are scheduled like groups. So what the heap on the driver sees is bounded by ``BINS``, however
many documents there are, and the loads differ by about the smallest bin.

A null text has no bytes, size ``ROW_BYTES`` and CRC 0; all null texts are one group, as empty texts
are another. Repeated rows belong to one group. Rows without an id take part. An empty table gives no
rows. Other columns are left out.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillgrain.llm.tables import query, table
from tillgrain.session import pin

SHARDS = 24
ROW_BYTES = 8
BINS = 1 << 14
#: Rows of a shard are numbered in so many parts.
CELLS = 1 << 10


def schedule(sizes: list[tuple[int, int]], shards: int) -> dict[int, int]:
    """Unit to shard: (unit, size) by size down, then unit, each to the least loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for unit, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        placed[unit] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, id: str = "doc_id", text: str = "text",
                   bins: int = BINS, cells: int = CELLS) -> DataFrame:
    """Per document its size, CRC, shard, and its place within the shard."""
    spark = docs.sparkSession
    body = F.col(f"`{text}`").cast("string")
    slim = pin(docs.select(
        F.col(f"`{id}`").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(F.coalesce(body, F.lit("")).cast("binary")).alias("text_crc32"),
        F.coalesce(F.md5(body.cast("binary")), F.lit("")).alias("group")))
    groups = slim.groupBy("group").agg(F.sum("size").alias("bytes"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    # At most ``bins`` groups can be this large.
    large = groups.where(F.col("bytes") > total / bins)
    named = {row["group"]: (bins + at, row["bytes"])
             for at, row in enumerate(large.orderBy("group").collect())}
    units = spark.createDataFrame([(g, u) for g, (u, _) in named.items()],
                                  "group string, unit int")
    in_bins = (slim.join(F.broadcast(units), "group", "left")
               .withColumn("unit", F.coalesce("unit", F.pmod(F.xxhash64("group"), F.lit(bins))
                                              .cast("int"))))
    sizes = in_bins.groupBy("unit").agg(F.sum("size").alias("bytes")).collect()
    placed = schedule([(row["unit"], row["bytes"]) for row in sizes], shards)
    to_shard = spark.createDataFrame(list(placed.items()), "unit int, shard int")
    dealt = (in_bins.join(F.broadcast(to_shard), "unit")
             .withColumn("cell", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(cells))
                         .cast("int")))
    # Slots: the rows of the shard's earlier cells, then the place in the cell.
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
              .select("shard", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0))
                      .alias("start")))
    inside = Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")
    return (dealt.withColumn("place", F.row_number().over(inside) - 1)
            .join(F.broadcast(starts), ["shard", "cell"])
            .select("doc_id", "size", "text_crc32", "shard",
                    (F.col("start") + F.col("place")).cast("long").alias("slot")))


@query("op6_sharding")
def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
