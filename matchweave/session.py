"""Session defaults and the shared folder used for checkpoints and stream state."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows that goes to Python, where the session sets no limit.
BATCH_BYTES = 1 << 20
#: Bytes of a row group that a task gathers before it writes, where the session sets no size.
ROW_GROUP_BYTES = 16 << 20


def local_session(cpus: int = 8, app: str = "matchweave", shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="matchweave-warehouse-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one only where none is set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = jvm_dir.get() if jvm_dir.isDefined() else None
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="matchweave-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and go on from the written table.

    It is computed once, lost executors do not cost more than a read, and later plans know its size.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_memory(spark: SparkSession, batch: int = BATCH_BYTES, row_group: int = ROW_GROUP_BYTES) -> None:
    """From now on rows go to Python, and into the row groups of written tables, in parts of about so many bytes.

    Without that a batch has as many rows as the session says, however long their texts are, and a task that writes texts holds
    a row group of the writer's default size. Limits that the session has already stay.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    named = spark.conf.get(name, None)
    if named is None or not named.isdigit() or int(named) >= 1 << 31:
        spark.conf.set(name, str(batch))
    if spark.conf.get("parquet.block.size", None) is None:
        spark.conf.set("parquet.block.size", str(row_group))


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """Use another value of a runtime setting inside the block."""
    old = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if old is None else spark.conf.set(name, old)
