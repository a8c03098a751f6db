"""Building blocks that stay correct and parallel when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchweave.session import durable

#: Rows of one key that may be handled together; above it a key is cut into slices.
SLICE_ROWS = 2_000_000
#: Order-column span of one block in blocked running sums.
BLOCK_SPAN = 4096


def within(df: DataFrame, rows: int) -> bool:
    """Does ``df`` hold at most ``rows`` rows? Reads no further than ``rows + 1``."""
    return df.limit(rows + 1).count() <= rows


def spread(scan: DataFrame) -> DataFrame:
    """Use all cores for a scan with fewer splits than cores; larger scans are left alone.

    Meant for a plain file scan in front of heavy per-row work.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def top_per_key(df: DataFrame, key: str, order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """Rank rows of each key and keep the first ``k``.

    ``row_number() <= k`` is planned with a group limit below the exchange, so a key that holds
    most rows still sends at most ``k`` rows per map task. Spark does so up to the ``k`` set in
    ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 unless changed).
    """
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.filter(F.col(rank) <= k).withColumn(rank, F.col(rank).cast("bigint"))


def dense_index(df: DataFrame, order: list[str | Column], out: str = "rank", start: int = 1) -> DataFrame:
    """Number all rows 1..n in a total order without moving them into one partition.

    Rows are range-partitioned and written out with their range; the offsets come from one count per
    range, so the only single-task step sees as many rows as there are ranges.
    """
    ranged = durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(out, (F.col("_before") + local + (start - 1)).cast("bigint"))
        .drop("_range", "_before")
    )


def running_sum(
    df: DataFrame,
    key: str,
    order: str,
    sums: dict[str, Column],
    span: int = BLOCK_SPAN,
    levels: int = 2,
) -> DataFrame:
    """Inclusive running sums of each key along an integer ``order`` column unique within the key.

    A key is cut into blocks of ``span`` order values. Blocks are summed independently, the block
    totals get their own running sum one level up, and each block adds what came before it. No
    task sees more than ``span`` rows of a key until the totals have shrunk by ``span ** levels``.
    Order values are expected to be roughly dense, as turn numbers are; take a larger ``span`` for
    sparse ones.
    """
    values = {name: f"_v{levels}_{i}" for i, name in enumerate(sums)}
    base = df.select("*", *[value.alias(values[name]) for name, value in sums.items()])
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    if levels == 0:
        window = upto.partitionBy(key)
        return base.select(*df.columns, *[F.sum(v).over(window).alias(name) for name, v in values.items()])

    block = f"_block{levels}"
    base = base.withColumn(block, F.floor(F.col(order) / F.lit(span)).cast("bigint"))
    totals = base.groupBy(key, block).agg(*[F.sum(v).alias(v) for v in values.values()])
    cumulated = running_sum(totals, key, block, {f"_c{v}": F.col(v) for v in values.values()}, span, levels - 1)
    before = cumulated.select(key, block, *[(F.col(f"_c{v}") - F.col(v)).alias(f"_b{v}") for v in values.values()])
    window = upto.partitionBy(key, block)
    local = base.select(
        *df.columns, block, *[F.sum(v).over(window).alias(f"_in{v}") for v in values.values()]
    )
    sums_out = [(F.col(f"_in{v}") + F.col(f"_b{v}")).alias(name) for name, v in values.items()]
    return local.join(before, [key, block]).select(*df.columns, *sums_out)


def sliced_join(
    big: DataFrame, small: DataFrame, key: str, spread: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Inner join on ``key`` that cuts keys with more than ``slice_rows`` rows in ``big`` into slices.

    Rows of a hot key are spread by a hash of ``spread`` and the matching rows of ``small`` are
    repeated once per slice. There are at most ``rows / slice_rows`` hot keys, so that list is
    small enough to broadcast whatever the input size.
    """
    hot = (
        big.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > slice_rows)
        .select(key, F.ceil(F.col("_n") / slice_rows).cast("int").alias("_slices"))
    )
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    left = big.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread), slices).cast("int")
    )
    right = small.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    return left.drop("_slices").join(right.drop("_slices"), [key, "_slice"]).drop("_slice")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
