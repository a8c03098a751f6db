"""Shards of bounded size by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchweave.session import durable

#: Byte limit of a shard.
SHARD_BYTES = 64 << 20
#: Directory bits taken from the key, then bits taken from the row itself.
KEY_BITS, ROW_BITS = 40, 20
#: Bits looked at in one round.
ROUND_BITS = 12


def hash_bits(key: Column, bits: int) -> Column:
    """The first ``bits`` (a multiple of 4) bits of the MD5 of ``key`` as text, as a number; null is the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, bits // 4), 16, 10).cast("bigint")


def assign_shards(
    docs: DataFrame, limit: int = SHARD_BYTES, key: str = "doc_id", text: str = "text", round_bits: int = ROUND_BITS
) -> DataFrame:
    """``key, n_bytes, shard, depth, shard_bytes, shard_docs`` of every row of ``docs``.

    The directory starts as one bucket. A bucket over ``limit`` splits on the next bit of the row's hash, and only
    such buckets do, so a bucket lies at the shortest prefix whose rows fit. ``depth`` is the number of bits and
    ``shard`` their text (empty for the one bucket that needs no split). One round adds up ``round_bits`` levels at
    once: the sizes of all prefixes come from one count per cell, and only rows of cells that are still too large go
    on.

    Null texts have no bytes; an empty table gives no rows. Rows with the same key share the first ``KEY_BITS`` bits
    and are told apart by a hash of the row's number, so many rows of one key still split. A row larger than
    ``limit`` ends alone (or with rows of no bytes) in the deepest bucket it reaches, which is then over the limit.
    Further columns of ``docs`` are not read.
    """
    sized = docs.select(F.col(key).alias("_key"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("_bytes"))
    total_bits = KEY_BITS + ROW_BITS
    row = F.monotonically_increasing_id()
    code = hash_bits(F.col("_key"), KEY_BITS) * (1 << ROW_BITS) + hash_bits(row, ROW_BITS)
    # the row numbers are written once, so a task that runs again cannot number rows anew
    rows = durable(sized.select("_key", "_bytes", code.alias("_code")))

    directory, known, open_cells = None, 0, None
    while known < total_bits:
        upto = min(known + round_bits, total_bits)
        cells = rows if open_cells is None else _inside(rows, open_cells, known, total_bits)
        cells = cells.groupBy(_prefix(upto, total_bits).alias("_cell")).agg(
            F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_docs")
        )
        levels = F.sequence(F.lit(known), F.lit(upto))
        above = cells.select(F.explode(levels).alias("_depth"), "_cell", "_bytes", "_docs").withColumn(
            "_bucket", F.expr(f"shiftright(_cell, {upto} - _depth)")
        )
        sizes = above.groupBy("_depth", "_bucket").agg(F.sum("_bytes").alias("_bytes"), F.sum("_docs").alias("_docs"))
        fits = (F.col("_bytes") <= limit) | (F.col("_docs") == 1) | (F.col("_depth") == total_bits)
        # sizes only shrink with depth: the bucket of a cell is its first prefix that fits
        found = above.select("_depth", "_bucket", "_cell").join(sizes.filter(fits), ["_depth", "_bucket"])
        best = found.groupBy("_cell").agg(F.min(F.struct("_depth", "_bucket", "_bytes", "_docs")).alias("_best"))
        level = durable(cells.select("_cell").join(best, "_cell", "left"))
        closed = level.filter("_best is not null").select("_best.*").distinct()
        directory = closed if directory is None else directory.unionByName(closed)
        open_cells, known = level.filter("_best is null").select("_cell"), upto
        if open_cells.isEmpty():
            break

    return _look_up(rows, durable(directory), total_bits).select(
        F.col("_key").alias(key),
        F.col("_bytes").alias("n_bytes"),
        F.when(F.col("_depth") == 0, F.lit("")).otherwise(F.lpad(F.bin("_bucket"), F.col("_depth"), F.lit("0"))).alias("shard"),
        F.col("_depth").cast("bigint").alias("depth"),
        F.col("_shard_bytes").alias("shard_bytes"),
        F.col("_docs").alias("shard_docs"),
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write ``docs`` as one folder per shard; ``key`` has to be unique here."""
    placed = docs.join(assigned.select(key, F.concat(F.lit("s"), "shard").alias("shard")), key)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)


def _prefix(depth: int, total_bits: int) -> Column:
    return F.shiftright("_code", total_bits - depth)


def _inside(rows: DataFrame, cells: DataFrame, depth: int, total_bits: int) -> DataFrame:
    return rows.withColumn("_cell", _prefix(depth, total_bits)).join(cells, "_cell", "left_semi").drop("_cell")


def _look_up(rows: DataFrame, directory: DataFrame, total_bits: int) -> DataFrame:
    """Join each row with the one directory entry on its path.

    Entries are keyed by depth and bits. Rows try the depths that occur in the directory, of which there are at
    most ``total_bits + 1``; that list is the only thing that is read on the driver.
    """
    depths = sorted(r._depth for r in directory.select("_depth").distinct().collect())
    entries = directory.select("_depth", "_bucket", F.col("_bytes").alias("_shard_bytes"), "_docs")
    if not depths:
        return rows.join(entries, F.lit(False), "left").filter("false")
    tries = F.array(*[F.struct(F.lit(d).alias("_depth"), _prefix(d, total_bits).alias("_bucket")) for d in depths])
    tried = rows.select("_key", "_bytes", F.explode(tries).alias("_try")).select("_key", "_bytes", "_try.*")
    return tried.join(entries, ["_depth", "_bucket"])
