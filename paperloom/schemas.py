"""Row types of the engine's relations."""

from __future__ import annotations

ELEMENT = "id string, page int, type string, bbox array<double>, text string, confidence double"
CHOICE = "struct<label:string,content_latex:string,sort_order:int>"
ISSUE = "struct<code:string,message:string,severity:string,field:string>"
PAYLOAD = (
    "question_type string, stem_latex string, choices array<struct<label:string,content_latex:string>>, answer_latex string, "
    "analysis_latex string, knowledge_points array<string>, difficulty int, "
    "confidence struct<structure:double,latex:double,answer:double,knowledge:double>, warnings array<string>"
)
IDENTITY = "paper_id string, block_id string, source_position_key string, text_fingerprint string, latex_fingerprint string, asset_signature string"

#: The stored tables and their primary keys.
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "papers": ("id string, title string, subject string, pdf_url string, pdf_type string, status string, created_at timestamp, updated_at timestamp", ("id",)),
    "parse_runs": ("id string, paper_id string, parser string, status string, metadata string, created_at timestamp", ("id",)),
    "question_blocks": (
        "id string, paper_id string, parse_run_id string, question_number string, section_title string, raw_markdown string, "
        "pages array<int>, bbox array<double>, split_confidence double, needs_review boolean, created_at timestamp",
        ("id",),
    ),
    "questions": (
        "id string, question_block_id string, subject string, grade string, question_type string, stem_latex string, answer_latex string, "
        "analysis_latex string, difficulty int, quality_status string, review_status string, source_location string, knowledge_points array<string>, "
        "created_at timestamp, updated_at timestamp",
        ("id",),
    ),
    "choices": ("id string, question_id string, label string, content_latex string, sort_order int", ("question_id", "label")),
    "question_assets": ("id string, question_id string, type string, storage_url string, page int, bbox array<double>, caption string, confidence double", ("id",)),
    "quality_reports": (
        f"id string, question_id string, rule_errors array<{ISSUE}>, render_errors array<{ISSUE}>, model_warnings array<string>, "
        "overall_score double, needs_review boolean, created_at timestamp",
        ("id",),
    ),
    "duplicate_candidate_groups": ("id string, fingerprint string, fingerprint_type string, candidate_count int, max_similarity double, status string, created_at timestamp, updated_at timestamp", ("id",)),
    "duplicate_candidate_items": (
        "id string, group_id string, block_id string, question_id string, paper_id string, section_path string, question_number string, "
        "source_position_key string, text_fingerprint string, latex_fingerprint string, asset_signature string",
        ("id",),
    ),
    "duplicate_review_decisions": ("id string, group_id string, decision string, canonical_question_id string, reviewer string, reason string, created_at timestamp", ("id",)),
    "canonical_questions": (
        "id string, canonical_fingerprint string, representative_item_id string, stem_latex string, answer_latex string, analysis_latex string, "
        "question_type string, difficulty int, status string, created_from_group_id string, created_at timestamp, updated_at timestamp",
        ("id",),
    ),
    "question_variants": (
        "id string, canonical_question_id string, question_id string, paper_id string, variant_type string, source_position_key string, "
        "text_fingerprint string, latex_fingerprint string, asset_signature string, is_active boolean",
        ("id",),
    ),
    "canonicalization_events": ("id string, canonical_question_id string, group_id string, event_type string, payload string, created_by string, created_at timestamp", ("id",)),
    "raw_assets": (
        "id string, paper_id string, page int, bbox array<double>, asset_type string, source_element_id string, crop_path string, storage_url string, "
        "perceptual_hash string, content_hash string, width double, height double, status string, created_at timestamp",
        ("id",),
    ),
    "question_asset_links": ("id string, question_id string, canonical_question_id string, raw_asset_id string, role string, confidence double, needs_review boolean", ("id",)),
    "canonical_assets": ("id string, asset_fingerprint string, representative_raw_asset_id string, asset_type string, storage_url string, perceptual_hash string, content_hash string, status string, created_at timestamp", ("id",)),
    "asset_variants": ("id string, canonical_asset_id string, raw_asset_id string, transform string, similarity double, is_active boolean", ("id",)),
}

#: Columns that an upsert changes where the key exists; others keep the stored value.
UPDATED: dict[str, tuple[str, ...]] = {
    "papers": ("title", "status", "updated_at"),
    "question_blocks": ("question_number", "section_title", "raw_markdown", "pages", "bbox", "split_confidence", "needs_review"),
    "questions": ("question_type", "stem_latex", "answer_latex", "analysis_latex", "difficulty", "quality_status", "review_status", "source_location", "knowledge_points", "updated_at"),
    "choices": ("content_latex", "sort_order"),
    "question_assets": ("type", "storage_url", "page", "bbox", "caption", "confidence"),
    "quality_reports": ("rule_errors", "render_errors", "model_warnings", "overall_score", "needs_review"),
    "duplicate_candidate_groups": ("candidate_count", "max_similarity", "status", "updated_at"),
    "duplicate_candidate_items": ("block_id", "question_id", "paper_id", "section_path", "question_number", "source_position_key", "text_fingerprint", "latex_fingerprint", "asset_signature"),
    "canonical_questions": ("canonical_fingerprint", "representative_item_id", "stem_latex", "answer_latex", "analysis_latex", "question_type", "difficulty", "status", "updated_at"),
    "question_variants": ("question_id", "is_active"),
    "raw_assets": ("bbox", "storage_url", "content_hash", "width", "height"),
    "question_asset_links": ("question_id", "canonical_question_id"),
    "canonical_assets": ("asset_fingerprint", "representative_raw_asset_id", "storage_url", "perceptual_hash", "status"),
    "asset_variants": ("similarity", "is_active"),
}
