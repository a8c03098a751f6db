"""Table schemas and fixed default values."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENT_FIELDS = [
    T.StructField("id", T.LongType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("title", T.StringType(), True),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType()), True),
    T.StructField("created_at", T.TimestampType(), True),
]
#: Both stored tables share one layout; ``TITLE_ALIAS`` gives the public name of ``title``.
DOCUMENT_SCHEMA = T.StructType(DOCUMENT_FIELDS)
TITLE_ALIAS = {"cvs": "candidate_name", "job_offers": "job_title"}

# Fixed values.
TOP_K = 10
HYBRID_TOP_K = 5
MATCH_TOP_K = 3
RRF_K = 60
LIST_DEPTH = 20
DOCUMENT_TASK = "search_document"
QUERY_TASK = "search_query"
MAX_TOKENS = 1800
RESPONSE_BUDGET = 400
KEEP_LAST = 4
CHARS_PER_TOKEN = 4
SUMMARY_CAP = 600
SUMMARY_TAIL = 300
