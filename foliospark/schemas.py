"""Domains and table schemas of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Domains of stored columns.
MODALITIES = ("article_text", "header_image", "multimodal_article")
STATES = ("eligible", "queued", "in_progress", "succeeded", "retryable", "terminal", "interrupted", "not_applicable", "stale_input", "stale_configuration")
DERIVATIONS = ("hosted_response", "synthetic_fixture", "long_text_aggregate", "multimodal_midpoint")
SUPERSESSIONS = ("input_changed", "explicit_reprocess")
MANIFEST_STATUSES = ("succeeded", "failed", "missing")
RUN_STATUSES = ("succeeded", "failed", "running")
RUN_COMMANDS = ("inventory", "run", "smoke", "validate")
RUN_SCOPE = r"(?:limit:[1-9][0-9]*(?:,reprocess)?|full(?:,reprocess)?|fixture)"
SYNTHETIC_CONTRACT = "synthetic-v1"
FAILURE_MESSAGES = {
    "invalid_timestamp": "timestamp is not valid ISO-8601",
    "missing_publication_timestamp": "article has no publication timestamp",
    "naive_timestamp": "timestamp has no timezone",
    "unreadable_source": "source cannot be read safely",
}


#: The columns of each table; `schema` parses them, which needs a session.
TABLES: dict[str, str] = {
    "metadata": "key string, value string",
    "runs": "run_id string, command string, scope string, status string, started_at timestamp, finished_at timestamp, summary_json string",
    "source_manifest": (
        "source_html_path string, html_size long, html_mtime_ns long, header_image_path string, header_image_size long, header_image_mtime_ns long, source_html_sha256 string, extractor_version string, status string, article_id string, last_run_id string, last_seen_run_id string"
    ),
    "candidates": (
        "source_html_path string, article_id string, source_html_sha256 string, extractor_version string, canonical_url string, published_at_utc timestamp, publication_date_new_york date, updated_at_utc timestamp, editorial_character_count long, editorial_block_count int, metadata_completeness int, header_image_path string, inline_image_urls array<string>, warnings array<string>, last_run_id string"
    ),
    "duplicates": "article_id string, source_html_path string, winner_source_html_path string, duplicate_rank int, reason string, run_id string",
    "failures": "run_id string, source_html_path string, stage string, error_code string, message string, extractor_version string, failed_at timestamp",
    "articles": (
        "article_id string, source_html_path string, cleaned_markdown_path string, markdown_sha256 string, header_image_path string, inline_image_urls array<string>, published_at_utc timestamp, publication_date_new_york date, updated_at_utc timestamp, last_run_id string"
    ),
    "embedding_work": (
        "article_id string, modality string, configuration_id string, source_relative_path string, input_sha256 string, state string, attempt_count int, error_code string, status_code int, retry_after_seconds double, last_run_id string, generation_run_id string, updated_at timestamp"
    ),
    "embedding_storage": (
        "article_id string, modality string, configuration_id string, source_relative_path string, published_at_utc timestamp, publication_date_new_york date, dimensions int, input_sha256 string, derivation_kind string, raw_response_sha256 string, response_model string, stored_vector_sha256 string, vector array<float>"
    ),
    "reconciliation_actions": (
        "run_id string, article_id string, modality string, configuration_id string, target_source_relative_path string, target_state string, expected_source_relative_path string, expected_input_sha256 string, expected_state string, expected_generation_run_id string, expected_vector_source_relative_path string, expected_vector_input_sha256 string, expected_derivation_kind string, expected_raw_response_sha256 string, expected_response_model string, expected_stored_vector_sha256 string, staged_at timestamp"
    ),
    "generation_history": (
        "article_id string, modality string, configuration_id string, generation_run_id string, source_relative_path string, input_sha256 string, derivation_kind string, raw_response_sha256 string, response_model string, stored_vector_sha256 string, superseded_run_id string, superseded_reason string, superseded_at timestamp"
    ),
    "embedding_configurations": (
        "configuration_id string, model string, observed_model string, client_api_contract_version string, task string, dimensions int, output_type string, normalization string, tokenizer_revision string, tokenizer_engine string, context_token_limit int, context_rules string, long_text_aggregation string, long_text_part_attempt_limit int, batch_max_items int, "
        "batch_max_estimated_tokens int, batch_max_encoded_bytes long, batch_max_response_bytes long, batch_max_concurrency int, batch_max_attempts int, batch_initial_backoff_seconds double, batch_max_backoff_seconds double, quota_max_requests int, quota_max_estimated_tokens int, quota_window_seconds int, image_input_rules string, image_transform string, "
        "multimodal_formula string, client_configuration_version string"
    ),
    "embedding_runs": (
        "run_id string, configuration_id string, scope string, status string, discovery_complete boolean, reconciliation_complete boolean, articles int, embeddings int, reused int, attempted int, succeeded int, retryable int, terminal int, interrupted int, header_absent int, header_failed int, hosted_requests int, hosted_retries int, usage_json string, throttles int, "
        "elapsed_seconds double, started_at timestamp, finished_at timestamp"
    ),
    "full_run_articles": "run_id string, article_id string, header_image_path string",
    "hosted_request_reservations": "reservation_id string, run_id string, configuration_id string, reserved_at timestamp, estimated_tokens int, observed_input_tokens int",
    "multimodal_embedding_provenance": "article_id string, configuration_id string, generation_run_id string, text_generation_run_id string, text_stored_vector_sha256 string, header_image_generation_run_id string, header_image_stored_vector_sha256 string, formula_version string, created_at timestamp",
    "image_input_provenance": (
        "article_id string, configuration_id string, generation_run_id string, source_sha256 string, source_format string, source_bytes long, source_width int, source_height int, source_frames int, embedded_input_sha256 string, embedded_format string, embedded_bytes long, embedded_width int, embedded_height int, embedded_frames int, transform_id string, "
        "rendition_relative_path string, created_at timestamp"
    ),
    "long_text_parts": (
        "article_id string, configuration_id string, article_input_sha256 string, part_index int, part_count int, char_start long, char_end long, byte_start long, byte_end long, part_input_sha256 string, token_count int, state string, attempt_count int, error_code string, status_code int, retry_after_seconds double, last_run_id string, generation_run_id string, "
        "derivation_kind string, raw_response_sha256 string, response_model string, stored_vector_sha256 string, vector array<float>, updated_at timestamp"
    ),
    "long_text_part_generations": (
        "article_id string, configuration_id string, article_input_sha256 string, part_index int, generation_run_id string, part_count int, char_start long, char_end long, byte_start long, byte_end long, part_input_sha256 string, token_count int, derivation_kind string, raw_response_sha256 string, response_model string, stored_vector_sha256 string, vector array<float>, created_at timestamp"
    ),
    "article_text_aggregation_provenance": "article_id string, configuration_id string, generation_run_id string, part_index int, article_input_sha256 string, part_count int, part_generation_run_id string, part_input_sha256 string, token_count int, part_stored_vector_sha256 string, aggregation_version string, created_at timestamp",
}


def schema(name: str) -> T.StructType:
    """The schema of table `name`."""
    return T.StructType.fromDDL(TABLES[name])


def check(df: DataFrame, name: str) -> DataFrame:
    """The frame, if its columns have the names and types of table `name`, in order; ValueError otherwise."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in schema(name)]
    if have != want:
        raise ValueError(f"table {name}: {sorted(set(have) ^ set(want))}")
    return df
