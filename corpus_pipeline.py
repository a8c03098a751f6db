"""From raw documents to packed training sequences: quality, near duplicates, benchmark passages, personal data, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.llm import contamination, packing, pii, quality, shingle_join
from matchweave.llm.queries import table, tokenizer_path
from matchweave.operators.scale import within
from matchweave.session import bounded_memory, durable

#: SQL cannot express the trained stages. A test holds every stage and run() against plain versions on a small corpus.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    bounded_memory(spark)
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates (five words, similarity 0.8).

    Documents without words are in no group. Of rows that repeat an id and are in one group, one stays. A row without
    an id stays only if no document with one is in its group.
    """
    bounded_memory(spark)
    members = shingle_join.near_duplicates(docs, keys=True).filter("group_key is not null")
    members = durable(members.select("doc_id", F.col("text_key").alias("_key"), "group_key"))
    smallest = F.min(F.struct(F.isnull("doc_id"), "doc_id", "_key")).alias("_first")
    first = durable(members.groupBy("group_key").agg(smallest).select("_first.doc_id", "_first._key"))
    rows = members.groupBy("doc_id", "_key").agg(F.count(F.lit(1)).alias("_n"))
    dropped = durable(rows.join(first, _same(rows, first), "left_anti").select("doc_id", "_key"))
    repeated = durable(rows.filter("_n > 1").join(first, _same(rows, first), "left_semi").select("doc_id", "_key"))
    key = "_key"
    while key in docs.columns:
        key += "_"
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = keyed.join(_small(dropped), _same(keyed, dropped, key), "left_anti")
    if not repeated.isEmpty():
        once = kept.join(_small(repeated), _same(kept, repeated, key), "left_semi").dropDuplicates(["doc_id", key])
        kept = kept.join(_small(repeated), _same(kept, repeated, key), "left_anti").unionByName(once)
    return kept.select(docs.columns)


def _same(left: DataFrame, right: DataFrame, key: str = "_key") -> Column:
    return (left[key] == right["_key"]) & left["doc_id"].eqNullSafe(right["doc_id"])


def _small(rows: DataFrame) -> DataFrame:
    """To be broadcast if it has few rows; else the texts are shuffled."""
    return F.broadcast(rows) if within(rows, shingle_join.BROADCAST_NODES) else rows


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bounded_memory(spark)
    return contamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind; ``n_chars`` follows the text."""
    bounded_memory(spark)
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast("bigint")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    bounded_memory(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = durable(docs)
    return docs
