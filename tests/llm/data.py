"""Small tables for the tests of this folder."""

from pyspark.sql import functions as F


def frame(spark, rows, schema, extra=False):
    """A small table; ``extra`` adds columns whose names clash with those used inside."""
    df = spark.createDataFrame(rows, schema)
    if extra:
        df = df.withColumns({name: F.lit("x") for name in ("_id", "_key", "_text", "n_words", "shard", "score", "_n", "host", "rule", "sequence_id")})
    return df
