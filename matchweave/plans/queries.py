"""The registered queries: every operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchweave.functions import guards as G
from matchweave.functions import prompts as P
from matchweave.functions import text as X
from matchweave.functions import vectors as V
from matchweave.operators import analysis as A
from matchweave.operators import ann, fulltext, fusion, inference, quality
from matchweave.operators import conversations as K
from matchweave.operators import vector_search as VS
from matchweave.operators.scale import within
from matchweave.plans import inputs as I
from matchweave.plans.matching import match_offers, with_keywords
from matchweave.schemas import KEEP_LAST, LIST_DEPTH, MATCH_TOP_K, QUERY_TASK, TOP_K
from matchweave.session import durable, scratch_path
from matchweave.sources import files, tables
from matchweave.streaming import compaction as running
from matchweave.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
CREATED = datetime(2024, 1, 1)
UPDATED = datetime(2024, 6, 1)
#: Share of the exact hits that the probed cells have to find.
ANN_RECALL = 0.9
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Tables and text ---------------------------------------------------------------------------------


@query
def table_stats(spark, folder):
    return tables.table_stats({"cvs": I.table(spark, folder, "documents"), "job_offers": I.table(spark, folder, "benchmark")})


@query
def list_candidates(spark, folder):
    return files.list_candidates(I.documents(spark, folder))


@query
def list_offers(spark, folder):
    items = I.table(spark, folder, "benchmark")
    return files.list_offers(items.select(F.concat(F.lit("offer_"), F.col("item_id").cast("string")).alias("filename")))


@query
def extract_name(spark, folder):
    dash = F.when(F.col("lang") == "en", " — ").when(F.col("lang") == "fr", "–").when(F.col("lang") == "de", " - ").otherwise("\n")
    text = F.concat(F.lit("\n  "), "source", F.lit(" "), "lang", dash, "raw_text")
    return I.documents(spark, folder).select("id", X.extract_name(text).alias("name"))


@query
def extract_title(spark, folder):
    label = F.when(F.col("lang") == "en", "Stanowisko:  ").otherwise("")
    text = F.concat(label, "raw_text")
    return I.documents(spark, folder).select("id", X.extract_title(text).alias("title"))


@query
def task_prefix(spark, folder):
    text = X.task_text(F.col("raw_text"), "search_document")
    return I.documents(spark, folder).select(
        "id", F.length(text).cast("bigint").alias("n_chars"), F.md5(text).alias("digest")
    )


@query
def dim_check(spark, folder):
    vectors = I.vectors(spark, folder)
    return vectors.groupBy(
        V.has_dim(F.col("embedding"), I.DIM).alias("valid"), F.size("embedding").cast("bigint").alias("found_dim")
    ).agg(F.count(F.lit(1)).alias("n"))


@query
def tokens_postings(spark, folder):
    posts = fulltext.postings(I.documents(spark, folder))
    return posts.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"), F.sum("pos").alias("sum_pos"), F.countDistinct("id").alias("n_docs")
    )


@query
def keyword_lookup(spark, folder):
    docs = I.documents(spark, folder)
    labels = I.table(spark, folder, "labels")
    known = labels.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("filename"),
        F.concat_ws(" ", F.lit("quality"), "quality", F.lit("toxic"), "toxic").alias("keywords"),
    )
    return with_keywords(docs.select("id", "filename"), known)


@query
def upsert_latest(spark, folder):
    docs = I.documents(spark, folder)
    no_vector = F.lit(None).cast("array<float>").alias("embedding")
    existing = docs.select(
        (F.col("id") + 1).alias("id"), "filename", F.col("lang").alias("title"), "raw_text", no_vector,
        F.lit(CREATED).cast("timestamp").alias("created_at"),
    )
    changed = docs.select(
        "filename", F.col("source").alias("title"), F.concat("lang", F.lit(": "), "raw_text").alias("raw_text"), no_vector, (F.col("id") * 2).alias("seq")
    )
    added = docs.select(
        F.concat_ws("_", F.lit("new"), "lang", "source").alias("filename"), F.col("filename").alias("title"), "raw_text",
        no_vector, (F.col("id") * 2 + 1).alias("seq"),
    )
    merged = tables.merged_rows(existing, changed.unionByName(added), UPDATED)
    return merged.select(
        "id", "filename", "title", F.md5("raw_text").alias("digest"), F.date_format("created_at", "yyyy-MM-dd").alias("created")
    )


def _as_files(spark, texts: DataFrame, path: str) -> str:
    """Write ``filename, raw_text`` to text files."""
    files.write_text_files(texts, path).agg(F.sum("n_files")).collect()
    return path


@query
def ingest_text_files(spark, folder):
    """Every document written to a text file of its own and read again with its title."""
    path = _as_files(spark, I.documents(spark, folder), scratch_path(spark, "text-files"))
    read = files.with_title(files.read_text_files(spark, path), "cvs")
    return read.select("filename", "title", F.length("raw_text").cast("bigint").alias("n_chars"), F.md5("raw_text").alias("digest"))


@query
def ingest_update(spark, folder):
    """Text files taken into a table: two thirds first; then a third has changed and the last third is new; then nothing is."""
    path = scratch_path(spark, "changed-files")
    name = "changed_" + path[-32:]
    tables.create_tables(spark, (name,), location=f"{path}/table", buckets=8)
    docs = I.documents(spark, folder).select("filename", "raw_text", "lang", (F.col("id") % 3).alias("third"))
    changed = F.when(F.col("third") == 1, F.concat("lang", F.lit(": "), "raw_text")).otherwise(F.col("raw_text"))
    model, taken = inference.hashed_embedding(I.DIM), []
    for batch in (docs.filter("third < 2"), docs.filter("third > 0").withColumn("raw_text", changed), docs.limit(0)):
        _as_files(spark, batch, f"{path}/files")
        taken.append(ingest.ingest_changed_files(spark, f"{path}/files", name, model, I.DIM, f"{path}/ledger", "cvs", created_at=CREATED))
    counts = [F.lit(n).cast("bigint").alias(f"taken_{i}") for i, n in enumerate(taken, 1)]
    return spark.table(name).select("filename", "title", F.md5("raw_text").alias("digest"), *counts)


@query
def bootstrap_stats(spark, folder):
    """Tables created and loaded from folders of text files; a second start finds them filled and loads nothing."""
    path = scratch_path(spark, "bootstrap")
    docs = I.documents(spark, folder)
    folders = {
        "cvs": _as_files(spark, docs, f"{path}/cvs"),
        "job_offers": _as_files(spark, I.offers(spark, folder), f"{path}/job_offers"),
    }
    model, suffix = inference.hashed_embedding(I.DIM), "_" + path[-32:]
    tables.bootstrap(spark, folders, model, I.DIM, suffix, f"{path}/tables", buckets=8)
    _as_files(spark, docs.select(F.concat(F.lit("late_"), "filename").alias("filename"), "raw_text"), f"{path}/cvs")
    return tables.bootstrap(spark, folders, model, I.DIM, suffix, f"{path}/tables")


@query
def match_offers_report(spark, folder):
    """The whole job for all offers and a name without one; every third offer goes by its name for want of keywords."""
    model = inference.hashed_embedding(I.DIM)
    docs = I.documents(spark, folder).select("id", "filename", F.col("lang").alias("title"), "raw_text")
    stored = durable(inference.embed(docs, model, I.DIM))
    items = durable(I.keyword_offers(spark, folder))
    requested = items.select("filename").unionByName(spark.range(1).select(F.lit("offer_unknown").alias("filename")))
    words = items.filter("query_id % 3 > 0").select("filename", "keywords")
    found = match_offers(requested, items, stored, words, model, inference.shared_word_scorer, I.DIM)
    missing = found.unmatched.select(F.col("filename").alias("query_id"), F.lit(None).cast("string").alias("report"))
    return found.reports.select("query_id", "report").unionByName(missing)


# Vectors -----------------------------------------------------------------------------------------


@query
def vector_topk(spark, folder):
    hits = VS.vector_search(I.offers(spark, folder), I.vectors(spark, folder), LIST_DEPTH, I.DIM)
    return rounded(hits.select("query_id", "id", "score", "rank"), 6, "score")


@query
def vector_topk_reverse(spark, folder):
    wanted = I.vectors(spark, folder).withColumnRenamed("id", "query_id")
    items = I.offers(spark, folder).select(F.col("query_id").alias("id"), "embedding")
    hits = VS.vector_search(wanted, items, TOP_K, I.DIM)
    return rounded(hits.select("query_id", "id", "score", "rank"), 6, "score")


@query
def vector_topk_blocked(spark, folder):
    """The two-sided block form, as used when the queries are too many to broadcast."""
    hits = VS.vector_search(
        I.offers(spark, folder), I.vectors(spark, folder), LIST_DEPTH, I.DIM, query_bytes=0, corpus_block=2_000, query_block=100
    )
    return rounded(hits.select("query_id", "id", "score", "rank"), 6, "score")


@query
def distance_listing(spark, folder):
    vectors = VS.valid_vectors(I.vectors(spark, folder), I.DIM)
    return rounded(VS.distance_listing(I.mean_vector(spark, folder), vectors), 6, "distance", "similarity")


@query
def rank_by_similarity(spark, folder):
    vectors = VS.valid_vectors(I.vectors(spark, folder), I.DIM)
    return rounded(VS.rank_by_similarity(I.mean_vector(spark, folder), vectors), 6, "score")


@query
def similarity_matrix(spark, folder):
    return rounded(VS.similarity_matrix(I.offers(spark, folder), I.vectors(spark, folder), I.DIM), 6, "similarity")


@query
def embed_documents(spark, folder):
    docs = I.documents(spark, folder).select("id", "raw_text")
    vectors = inference.embed(docs, inference.hashed_embedding(I.DIM), I.DIM).select("id", F.posexplode("embedding").alias("slot", "x"))
    used = vectors.filter(F.col("x") != 0)
    return used.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_slots"), F.round(F.sum(F.col("x").cast("double") * (F.col("slot") + 1)), 4).alias("weighted")
    )


@query
def asymmetric_rank(spark, folder):
    """Offers embedded as queries against documents embedded as documents."""
    model = inference.hashed_embedding(I.DIM)
    docs = inference.embed(I.documents(spark, folder).select("id", "raw_text"), model, I.DIM)
    wanted = inference.embed(I.offers(spark, folder).select("query_id", "raw_text"), model, I.DIM, task=QUERY_TASK)
    hits = VS.vector_search(wanted, docs, TOP_K, I.DIM)
    return rounded(hits.select("query_id", "id", "score", "rank"), 5, "score")


@query
def embedding_max_diff(spark, folder):
    """Vectors made in model batches against vectors made one text at a time."""
    docs = I.documents(spark, folder).select("id", "raw_text")
    model = inference.hashed_embedding(I.DIM)
    return VS.embedding_max_diff(
        inference.embed(docs, model, I.DIM), inference.embed(docs, model, I.DIM, batch=1)
    )


@query
def ann_topk(spark, folder):
    """Cells are read in the order of their bounds until the next one is beyond the last hit."""
    found = ann.cell_search(I.offers(spark, folder), _index(spark, folder), LIST_DEPTH, I.DIM)
    return rounded(found.hits.drop("distance"), 6, "score")


@query
def ann_topk_all_cells(spark, folder):
    """Probing every cell has to give the exact lists."""
    index = _index(spark, folder)
    hits = ann.ann_search(I.offers(spark, folder), index, LIST_DEPTH, I.DIM, nprobe=index.n_cells)
    return rounded(hits.select("query_id", "id", "score", "rank"), 6, "score")


@query
def ann_recall(spark, folder):
    """The cells that ``ann_topk`` probes have to find the stated share of the exact hits of all offers."""
    index, wanted = _index(spark, folder), I.offers(spark, folder)
    exact = durable(VS.vector_search(wanted, I.vectors(spark, folder), LIST_DEPTH, I.DIM))
    nprobe = ann.probes_needed(index, wanted, LIST_DEPTH, I.DIM, ANN_RECALL, exact=exact)
    found = ann.recall(exact, ann.ann_search(wanted, index, LIST_DEPTH, I.DIM, nprobe))
    return found.agg(F.count(F.lit(1)).alias("n_queries"), (F.avg("recall") >= ANN_RECALL).alias("enough"))


def _index(spark, folder) -> ann.CellIndex:
    return ann.build_index(I.vectors(spark, folder), n_cells=None, dim=I.DIM)


# Keywords and fusion -----------------------------------------------------------------------------


def _terms(spark, folder):
    return fulltext.query_terms(I.keyword_offers(spark, folder))


@query
def fulltext_match(spark, folder):
    return fulltext.fulltext_match(_terms(spark, folder), fulltext.postings(I.documents(spark, folder)))


@query
def fulltext_topk(spark, folder):
    hits = fulltext.fulltext_search(_terms(spark, folder), fulltext.postings(I.documents(spark, folder)), TOP_K)
    return rounded(hits, 8, "score")


@query
def fulltext_topk_reverse(spark, folder):
    texts = I.documents(spark, folder).select(F.col("id").alias("query_id"), F.col("raw_text").alias("text"))
    docs = I.rare_keywords(texts, I.table(spark, folder, "benchmark"))
    items = I.offers(spark, folder).select(F.col("query_id").alias("id"), "raw_text")
    hits = fulltext.fulltext_search(fulltext.query_terms(docs), fulltext.postings(items), TOP_K)
    return rounded(hits, 8, "score")


@query
def rrf_fusion_lists(spark, folder):
    wanted, corpus = durable(I.keyword_offers(spark, folder)), I.corpus(spark, folder)
    by_vector = VS.vector_search(wanted, corpus.vectors, LIST_DEPTH, I.DIM)
    by_text = fulltext.fulltext_search(fulltext.query_terms(wanted), fulltext.postings(corpus.texts), LIST_DEPTH)
    fused = fusion.fuse(by_vector, by_text)
    return rounded(fused.select("query_id", "id", "vec_rank", "text_rank", "rrf_score"), 8, "rrf_score")


def _hybrid(spark, folder, k):
    return fusion.hybrid_search(durable(I.keyword_offers(spark, folder)), I.corpus(spark, folder), I.DIM, k)


@query
def hybrid_topk(spark, folder):
    hits = _hybrid(spark, folder, fusion.HYBRID_TOP_K).drop("name")
    return rounded(rounded(hits, 8, "rrf_score", "text_score"), 6, "vec_score")


@query
def rank_quality(spark, folder):
    """How often an offer's own document comes first by vector."""
    wanted = I.offers(spark, folder)
    hits = VS.vector_search(wanted, I.vectors(spark, folder), TOP_K, I.DIM)
    expected = wanted.select("query_id", F.col("query_id").alias("expected_id"))
    return rounded(quality.rank_quality(hits, expected, TOP_K), 6, "reciprocal_rank")


@query
def rank_quality_hybrid(spark, folder):
    expected = I.offers(spark, folder).select("query_id", F.col("query_id").alias("expected_id"))
    per_query = quality.rank_quality(_hybrid(spark, folder, TOP_K), expected, TOP_K)
    return rounded(quality.quality_summary(per_query), 6, "hit_at_1", "hit_at_k", "mrr")


# Screening, prompts, repair ----------------------------------------------------------------------


@query
def input_guard(spark, folder):
    return A.screen(I.screened_texts(spark, folder)).pattern_counts


@query
def input_quarantine(spark, folder):
    return A.screen(I.screened_texts(spark, folder)).quarantine.select("id", F.length("raw_text").cast("bigint").alias("n_chars"))


@query
def input_clean(spark, folder):
    clean = A.screen(I.screened_texts(spark, folder)).clean
    return clean.select(
        "id", "was_truncated", F.length("safe_text").cast("bigint").alias("n_chars"), F.md5("safe_text").alias("digest")
    )


@query
def prompt_build(spark, folder):
    prompt = P.prompt(F.col("document_text"), F.col("offer_text"))
    return I.pairs(spark, folder).select("id", "query_id", F.length(prompt).cast("bigint").alias("n_chars"), F.md5(prompt).alias("digest"))


@query
def prompt_messages(spark, folder):
    prompt = P.prompt(F.col("document_text"), F.col("offer_text"))
    rows = I.pairs(spark, folder).select("id", F.posexplode(P.messages(prompt)).alias("pos", "m"))
    return rows.select("id", F.col("pos").cast("bigint").alias("pos"), "m.role", F.md5("m.content").alias("digest"))


@query
def guard_extract_json(spark, folder):
    return I.responses(spark, folder).select("id", G.find_json(F.col("raw")).alias("json"))


def _repaired(spark, folder):
    return G.repair(I.responses(spark, folder))


@query
def guard_score(spark, folder):
    return _repaired(spark, folder).select("id", F.col("analysis.score").cast("bigint").alias("score"))


@query
def guard_lists(spark, folder):
    return _repaired(spark, folder).select(
        "id",
        F.array_join("analysis.key_matches", "|").alias("key_matches"),
        F.array_join("analysis.gaps", "|").alias("gaps"),
    )


@query
def guard_recommendation(spark, folder):
    return _repaired(spark, folder).select(
        "id",
        F.col("analysis.recommendation").alias("recommendation"),
        F.array_join("analysis.warnings", "|").alias("warnings"),
        F.col("analysis.error").alias("error"),
        F.col("analysis.raw").alias("raw"),
    )


@query
def guard_status(spark, folder):
    return A.guard_report(_repaired(spark, folder))


@query
def guard_warnings(spark, folder):
    return A.warning_report(_repaired(spark, folder))


def _flat(analysed: DataFrame, *keys: str) -> DataFrame:
    return analysed.select(
        *keys,
        F.col("analysis.score").cast("bigint").alias("score"),
        F.array_join("analysis.key_matches", "|").alias("key_matches"),
        F.array_join("analysis.gaps", "|").alias("gaps"),
        F.col("analysis.recommendation").alias("recommendation"),
    )


@query
def analyze_pairs(spark, folder):
    return _flat(A.analysed_pairs(I.pairs(spark, folder), inference.shared_word_scorer), "id", "query_id")


def _analysed_hits(spark, folder):
    wanted = I.offers(spark, folder)
    few = within(wanted.select("query_id"), fusion.BROADCAST_HITS // MATCH_TOP_K)
    hits = _hybrid(spark, folder, MATCH_TOP_K)
    return A.analysed_hits(hits, I.documents(spark, folder), wanted, inference.shared_word_scorer, few)


@query
def analyze_topk(spark, folder):
    return _flat(_analysed_hits(spark, folder), "query_id", "rank", "id", "filename")


@query
def match_report(spark, folder):
    return A.match_report(_analysed_hits(spark, folder))


# Conversations -----------------------------------------------------------------------------------


@query
def token_usage(spark, folder):
    return K.token_usage(I.messages(spark, folder))


@query
def running_tokens(spark, folder):
    return K.running_tokens(I.messages(spark, folder))


@query
def keep_last_messages(spark, folder):
    return K.keep_last(I.messages(spark, folder), KEEP_LAST).select("conv_id", "turn", "role", F.md5("content").alias("digest"))


@query
def transcript(spark, folder):
    return K.transcript(I.messages(spark, folder)).select(
        "conv_id", "part", F.length("transcript").cast("bigint").alias("n_chars"), F.md5("transcript").alias("digest")
    )


@query
def fallback_summary(spark, folder):
    return K.fallback_summaries(I.messages(spark, folder))


def _state_view(states: DataFrame) -> DataFrame:
    return states.select("conv_id", "summary", "n_compactions", "start_turn", "n_messages", "chars")


@query
def compact_history(spark, folder):
    return _state_view(K.compact_history(I.messages(spark, folder), I.CHAT_BUDGET))


@query
def compact_history_long(spark, folder):
    """The form for conversations of any length has to agree with the fold."""
    return _state_view(K.compact_history(I.messages(spark, folder), I.CHAT_BUDGET, fold_rows=0))


@query
def compact_history_once(spark, folder):
    return _state_view(K.compact_history(I.messages(spark, folder), I.CHAT_BUDGET, check="end"))


def _with_resets(spark, folder):
    """The given chats with some questions turned into resets."""
    due = (F.col("role") == "user") & ((F.col("conv_id") * 7 + F.col("turn")) % 11 == 0)
    return I.messages(spark, folder).withColumn("content", F.when(due, F.lit(" /Reset ")).otherwise(F.col("content")))


@query
def compact_history_reset(spark, folder):
    return _state_view(K.compact_history(_with_resets(spark, folder), I.CHAT_BUDGET))


@query
def compact_history_reset_long(spark, folder):
    """The form for conversations of any length begins after the last reset."""
    return _state_view(K.compact_history(_with_resets(spark, folder), I.CHAT_BUDGET, fold_rows=0))


@query
def compact_history_model(spark, folder):
    """Summaries by a model, in parts and parts of their summaries."""
    states = K.compact_history(
        I.messages(spark, folder), I.CHAT_BUDGET, check="end", summarizer=inference.sized_summary, part_chars=I.PART_CHARS
    )
    return _state_view(states)


@query
def compacted_usage(spark, folder):
    return K.state_usage(K.compact_history(I.messages(spark, folder), I.CHAT_BUDGET), I.CHAT_BUDGET)


@query
def build_messages(spark, folder):
    chats = I.messages(spark, folder)
    rows = K.build_messages(chats, durable(K.compact_history(chats, I.CHAT_BUDGET)))
    return rows.select(
        "conv_id", F.col("section").cast("bigint").alias("section"), "turn", "role", F.md5("content").alias("digest")
    )


@query
def conversation_reset(spark, folder):
    """History left when every chat is reset after its first answer."""
    chats = I.messages(spark, folder)
    resets = chats.filter(F.col("role") == "assistant").groupBy("conv_id").agg(F.min("turn").alias("turn"))
    return K.after_reset(chats, resets).select("conv_id", "turn", "role", F.md5("content").alias("digest"))


@query
def chat_answers(spark, folder):
    return K.answers(I.messages(spark, folder), inference.last_words_answer, I.CHAT_BUDGET)


# Streams -----------------------------------------------------------------------------------------


def _stream(spark, folder, name):
    # a pattern takes the table both as one file and as a folder of part files
    schema = I.table(spark, folder, name).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


@query
def stream_ingest(spark, folder):
    path = scratch_path(spark, "stream-ingest")
    name = "ingest_" + path[-32:]
    tables.create_tables(spark, (name,), location=path)
    texts = _stream(spark, folder, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("filename"), F.col("text").alias("raw_text"), F.col("doc_id").alias("seq")
    )
    ingest.ingest_stream(
        texts, name, inference.hashed_embedding(I.DIM), I.DIM, f"{path}/progress", created_at=CREATED
    ).awaitTermination()
    return spark.table(name).select("id", "filename", F.md5("raw_text").alias("digest"), F.size("embedding").cast("bigint").alias("dim"))


@query
def stream_compact(spark, folder):
    path = scratch_path(spark, "stream-compact")
    chats = _stream(spark, folder, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
    states = running.running_compaction(chats, I.CHAT_BUDGET)
    running.write_states(states, f"{path}/states", f"{path}/progress").awaitTermination()
    return _state_view(running.latest_states(spark.read.parquet(f"{path}/states")))


@query
def stream_compact_gaps(spark, folder):
    """Chats that begin at turn 1 and lack every other turn, in two batches."""
    path = scratch_path(spark, "stream-gaps")
    chats = I.messages(spark, folder).withColumn("turn", F.col("turn") * 2 + 1)
    for early in (True, False):
        # a run of the stream takes what was written since the last one, as one batch of any number of files
        chats.filter((F.col("turn") < 6) == early).write.mode("append").parquet(f"{path}/chats")
        stream = spark.readStream.schema(chats.schema).parquet(f"{path}/chats")
        states = running.running_compaction(stream, I.CHAT_BUDGET, first_turn=None, gap_seconds=0)
        running.write_states(states, f"{path}/states", f"{path}/progress").awaitTermination()
    return _state_view(running.latest_states(spark.read.parquet(f"{path}/states")))


@query
def upsert_then_search(spark, folder):
    """Keyword search on the stored index after a second batch emptied some texts and changed others."""
    path = scratch_path(spark, "upsert-search")
    name = "search_" + path[-32:]
    tables.create_tables(spark, (name,), location=path, buckets=8)
    docs = I.documents(spark, folder).select(
        "filename", F.col("source").alias("title"), "raw_text", F.lit(None).cast("array<float>").alias("embedding"), F.col("id").alias("seq"), "lang"
    )
    tables.upsert(spark, name, docs.drop("lang"), I.DIM, CREATED)
    text = F.when(F.col("seq") % 5 == 0, F.lit("---")).otherwise(F.concat_ws(" ", "lang", "raw_text", "title"))
    tables.upsert(spark, name, docs.filter("seq % 5 < 2").withColumn("raw_text", text).drop("lang"), I.DIM, UPDATED)
    terms = durable(_terms(spark, folder))
    hits = fulltext.fulltext_search(terms, tables.read_postings(spark, name, terms), TOP_K)
    return rounded(hits, 8, "score")
