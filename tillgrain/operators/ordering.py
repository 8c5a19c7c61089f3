"""Global order over frames too large for one task.

A window without PARTITION BY sends every row to one task. Here the rows are range-partitioned on a
total order instead, each slice is ordered on its own, and the few slice totals are carried over as
offsets. The order must end in a unique key: ties then spread over slices like any other rows, so a
value shared by a third of the rows is no hot spot.

The sliced frame is pinned, because sampled range bounds differ from run to run while the offsets
and the per-slice pass must agree on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillgrain.session import pin

SLICE = "_slice"


def _slice(df: DataFrame, order: list[Column], slices: int | None) -> DataFrame:
    spread = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return pin(spread.withColumn(SLICE, F.spark_partition_id()))


def with_running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column], *,
                      totals: dict[str, str] | None = None, slices: int | None = None
                      ) -> DataFrame:
    """Add, for each name in ``sums``, the sum of its column over all rows up to and including this
    one. ``totals`` maps such a name to a further column that gets the grand total."""
    staged = df
    for name, value in sums.items():
        staged = staged.withColumn(f"_in_{name}", value)
    sliced = _slice(staged, order, slices)

    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding,
                                                   Window.unboundedFollowing)
    per_slice = sliced.groupBy(SLICE).agg(*[F.sum(f"_in_{n}").alias(f"_sum_{n}") for n in sums])
    offsets = per_slice.select(
        SLICE,
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_off_{n}") for n in sums],
        *[F.sum(f"_sum_{n}").over(everything).alias(f"_tot_{n}") for n in sums])

    inside = (Window.partitionBy(SLICE).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The offsets hold one row per slice, so their size is bounded by the shuffle width.
    joined = sliced.join(F.broadcast(offsets), SLICE)
    for name in sums:
        joined = joined.withColumn(name, F.sum(f"_in_{name}").over(inside) + F.col(f"_off_{name}"))
    for name, total in (totals or {}).items():
        joined = joined.withColumn(total, F.col(f"_tot_{name}"))
    spent = [SLICE] + [f"{p}_{n}" for n in sums for p in ("_in", "_off", "_tot")]
    return joined.drop(*spent)


def with_row_number(df: DataFrame, order: list[Column], name: str = "rn",
                    count: str | None = None, slices: int | None = None) -> DataFrame:
    """ROW_NUMBER() over the whole frame, and the number of rows where ``count`` names a column."""
    return with_running_sums(df, order, {name: F.lit(1).cast("bigint")},
                             totals={name: count} if count else None, slices=slices)


def ntile_of(rn: Column, n: Column, tiles: int) -> Column:
    """The NTILE bucket that row ``rn`` of ``n`` falls into: the first ``n mod tiles`` buckets hold
    one row more than the others."""
    size = F.floor(n / tiles)
    larger = n % tiles
    rows_in_larger = larger * (size + 1)
    return (F.when(rn <= rows_in_larger, F.ceil(rn / (size + 1)))
            .otherwise(larger + F.ceil((rn - rows_in_larger) / F.nullif(size, F.lit(0))))
            .cast("int"))


def with_ntile(df: DataFrame, tiles: int, order: list[Column], name: str,
               slices: int | None = None) -> DataFrame:
    numbered = with_row_number(df, order, "_rn", "_n", slices)
    return (numbered.withColumn(name, ntile_of(F.col("_rn"), F.col("_n"), tiles))
            .drop("_rn", "_n"))


def with_rank(df: DataFrame, value: str, name: str, *, dense: bool = False,
              slices: int | None = None) -> DataFrame:
    """RANK (or DENSE_RANK) by ``value`` descending, nulls first.

    Ranks are settled on the distinct values, which are unique and so slice evenly however many rows
    share one of them, then joined back to the rows.
    """
    values = df.groupBy(value).agg(F.count(F.lit(1)).alias("_rows"))
    step = F.lit(1).cast("bigint") if dense else F.col("_rows")
    upto = with_running_sums(values, [F.col(value).desc_nulls_first()], {"_upto": step},
                             slices=slices)
    rank = F.col("_upto") if dense else F.col("_upto") - F.col("_rows") + 1
    ranks = upto.select(F.col(value).alias("_value"), rank.cast("int").alias(name))
    return (df.join(ranks, F.col(value).eqNullSafe(F.col("_value")))
            .select(*df.columns, name))


def exact_quantiles(df: DataFrame, column: str, probabilities: list[float],
                    slices: int | None = None) -> dict[float, float | None]:
    """Quantiles with linear interpolation between neighbouring values.

    Works on (value, count) pairs in slices. The ``percentile`` aggregate would merge every distinct
    value in one task. One row reaches the driver, null where there are no values.
    """
    hist = (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    upto = with_running_sums(hist, [F.col("_v")], {"_upto": F.col("_c")},
                             totals={"_upto": "_all"}, slices=slices)

    def first_beyond(position: Column) -> Column:
        return F.min(F.when(F.col("_upto") > position, F.col("_v"))).cast("double")

    sides = []
    for i, p in enumerate(probabilities):
        low = F.floor(F.lit(p) * (F.col("_all") - 1))
        high = F.least(low + 1, F.col("_all") - 1)
        sides += [first_beyond(low).alias(f"low{i}"), first_beyond(high).alias(f"high{i}")]
    found = upto.agg(F.max("_upto").alias("n"), *sides).first()
    result: dict[float, float | None] = {}
    for i, p in enumerate(probabilities):
        low, high = found[f"low{i}"], found[f"high{i}"]
        place = p * ((found["n"] or 1) - 1)
        result[p] = None if low is None else low + (high - low) * (place - int(place))
    return result
