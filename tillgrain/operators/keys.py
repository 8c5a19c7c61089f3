"""Keys that come more than once, found by their hashes.

Equal keys have equal hashes, so a row whose hash comes once is the only one with its key. Counting
hashes moves a few bytes per row instead of the row or its key; only rows with a repeated hash are then
looked at by the key itself, so keys that share a hash by chance cost a little work and change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F

from tillgrain.session import pin

HASH = "_hash"
#: With more than this share of rows under repeated hashes, looking at them apart saves nothing.
FEW = 0.2


def keep_first(df: DataFrame, key: list[str], sequence: list[str]) -> DataFrame:
    """One row per key, the earliest in ``sequence``; null keys count as equal.

    Spark keeps at most one row per key and task before the shuffle (a window group limit), so
    many copies of one key never meet in a task.
    """
    earliest = Window.partitionBy(*key).orderBy(*[F.col(c) for c in sequence])
    return df.withColumn("_nth", F.row_number().over(earliest)).where("_nth = 1").drop("_nth")


def _hashed(df: DataFrame, key: list[str]) -> DataFrame:
    return df.withColumn(HASH, F.xxhash64(*key))


def repeated_hashes(df: DataFrame, key: list[str]) -> tuple[DataFrame, int, int]:
    """The hashes of the key that come more than once, pinned; all rows, and the rows under such hashes."""
    seen, n = Observation(), F.col("_rows")
    counts = (_hashed(df, key).groupBy(HASH).agg(F.count(F.lit(1)).alias("_rows"))
              .observe(seen, F.sum(n).alias("rows"), F.sum(F.when(n > 1, n)).alias("again")))
    again = pin(counts.where("_rows > 1").select(HASH))
    return again, seen.get.get("rows") or 0, seen.get.get("again") or 0


def keep_first_reread(df: DataFrame, key: list[str], sequence: list[str]) -> DataFrame:
    """The rows of ``keep_first``, from a frame that can be read again at little cost, such as files: rows
    whose key comes once are not shuffled."""
    hashes, rows, again = repeated_hashes(df, key)
    if not again:
        return df
    if again > FEW * rows:
        return keep_first(df, key, sequence)
    hashed = _hashed(df, key)
    once = hashed.join(hashes, HASH, "left_anti")
    first = keep_first(hashed.join(hashes, HASH, "left_semi"), key, sequence)
    return once.unionByName(first).select(*df.columns)


def repeats(df: DataFrame, key: list[str]) -> DataFrame:
    """total and failed: all rows, and those beyond the first of each key; null keys are equal to each
    other."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
            .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"),
                 F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("failed")))


def repeats_reread(df: DataFrame, key: list[str]) -> DataFrame:
    """``repeats`` of a frame that can be read again at little cost."""
    hashes, rows, again = repeated_hashes(df, key)
    if again > FEW * rows:
        return repeats(df, key)
    all_rows = F.lit(rows).cast("bigint").alias("total")
    if not again:
        return df.sparkSession.range(1).select(all_rows, F.lit(0).cast("bigint").alias("failed"))
    found = _hashed(df, key).join(hashes, HASH, "left_semi")
    return repeats(found, key).select(all_rows, "failed")
