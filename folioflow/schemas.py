"""Schemas of the files that the engine reads and writes. Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

from folioflow.functions.contract import RESPONSE

PAPER_LIST = T.StructType([T.StructField(c, T.StringType()) for c in ("anthology_id", "paper_id", "page_url", "title")])
TITLES = T.StructType([T.StructField(c, T.StringType()) for c in ("paper_id", "anthology_id", "title")])
RESULT_METADATA = T.StructType([
    T.StructField("artifact_dir", T.StringType()), T.StructField("context_file", T.StringType()), T.StructField("image_files", T.ArrayType(T.StringType())), T.StructField("image_count", T.IntegerType()),
    T.StructField("client_calls", T.IntegerType()), T.StructField("contract_retries_used", T.IntegerType()), T.StructField("throttles_surfaced", T.IntegerType()),
    T.StructField("started_at", T.TimestampType()), T.StructField("completed_at", T.TimestampType()), T.StructField("latency_seconds", T.DoubleType()),
])
RESULT = T.StructType([
    T.StructField("paper_id", T.StringType()), T.StructField("position", T.IntegerType()), T.StructField("status", T.StringType()), T.StructField("response", RESPONSE), T.StructField("error_type", T.StringType()),
    T.StructField("error", T.StringType()), T.StructField("retryable_at_failure", T.BooleanType()), T.StructField("metadata", RESULT_METADATA),
])
MANIFEST = T.StructType([T.StructField(c, T.StringType()) for c in ("run_id", "embedding_id", "paper_id", "embedding_type", "schema_version", "model", "text_hash", "status", "chroma_collection", "facet", "error")])
STORE_METADATA = T.StructType([T.StructField(c, T.StringType()) for c in ("paper_id", "embedding_type", "schema_version", "embedding_model", "text_hash", "run_id", "facet")])
STORE = T.StructType([T.StructField("id", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("document", T.StringType()), T.StructField("metadata", STORE_METADATA)])
