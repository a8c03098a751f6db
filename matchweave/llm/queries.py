"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.llm.block_topk import top_k
from matchweave.llm.contamination import find_benchmark
from matchweave.llm.hard_negatives import hard_negatives
from matchweave.llm.html_text import extract_text
from matchweave.llm.language_model import score_texts
from matchweave.llm.packing import pack_documents
from matchweave.llm.pii import find_pii
from matchweave.llm.pii import train as train_tagger
from matchweave.llm.quality import held_out, score_quality, train
from matchweave.llm.sharding import assign_shards
from matchweave.llm.shingle_join import near_duplicates
from matchweave.llm.spelling import spelling_variants
from matchweave.llm.substring_dedup import remove_repeats
from matchweave.llm.url_filter import judge_urls

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_substring_dedup(spark, folder):
    """Every document without the 50-word passages that an earlier one has."""
    return remove_repeats(table(spark, folder, "documents"))


@query
def op2_extendible_shards(spark, folder):
    """Every document with its shard of at most 64 MiB."""
    return assign_shards(table(spark, folder, "documents"))


@query
def op3_quality_attention(spark, folder):
    """Every document with its quality score by a model fitted outside the held-out fold."""
    docs = table(spark, folder, "documents")
    scored = score_quality(docs, train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op4_shingle_join(spark, folder):
    """Every document with its component of documents that share 85 % of their 4-word shingles."""
    return near_duplicates(table(spark, folder, "documents"), n=4, threshold=(85, 100))


@query
def op5_benchmark_passages(spark, folder):
    """Every document that holds a benchmark item, with the best window."""
    return find_benchmark(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_block_topk(spark, folder):
    """The five nearest vectors of every fiftieth vector."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def tokenizer_path() -> str:
    """The public vocabulary that the packing query counts in."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op7_sequence_packing(spark, folder):
    """Every piece of every document with its place in a sequence of at most 2048 tokens."""
    return pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query
def op8_pii_tagger(spark, folder):
    """Every document with its personal data."""
    docs = table(spark, folder, "documents")
    return find_pii(docs, train_tagger(docs))


@query
def op9_html_text(spark, folder):
    """Every page with its main text."""
    return extract_text(table(spark, folder, "pages"))


@query
def op10_url_rules(spark, folder):
    """Every page with its host, path, deciding site rule and verdict."""
    return judge_urls(table(spark, folder, "pages"))


@query
def op11_pitman_yor(spark, folder):
    """Every document with its log10 probability by a model learnt from six sevenths of them."""
    return score_texts(table(spark, folder, "documents"))


@query
def op12_spelling_variants(spark, folder):
    """Every frequent word with the words one edit away, its form and its root."""
    return spelling_variants(table(spark, folder, "documents"))


@query
def op13_hard_negatives(spark, folder):
    """Hard negatives of every hundredth vector, with a seventh of the labels moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, moved)
