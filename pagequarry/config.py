"""Job parameters and the fixed values every operator shares."""

from __future__ import annotations

from dataclasses import dataclass

# File types, categories, statuses and labels that stored records use.
FILE_TYPES = {".pdf": "pdf", ".xlsx": "excel", ".csv": "csv"}
CATEGORIES = ("financial", "legal", "transcript", "other")
STATUS_LABELS = {"completed": "OK", "failed": "Failed", "skipped": "Skipped", "superseded": "Superseded"}
STATUS_SYMBOLS = {"OK": "✅ OK", "Failed": "❌ Failed", "Unknown": "❓ Unknown",
                  "Skipped": "⚠️ Skipped", "Superseded": "⏭️ Superseded"}
UNSUPPORTED_ERROR = "Unsupported file type"
EMBED_ERROR = "Failed to create embeddings"
SEPARATORS = ("\n\n", "\n", ". ", " ", "")
DOC_ID_CHARS = 100
SAMPLE_ROWS = 5
PREVIEW_COLUMNS = 10


@dataclass(frozen=True)
class JobConfig:
    """Settings of one run; the defaults are those of the command-line tool this replaces."""

    input_dir: str = "docs"
    output_dir: str = "build"
    embed: bool = False
    embedding_model: str = "tfidf"
    chunker: str = "recursive"
    chunk_size: int = 1000
    chunk_overlap: int = 200
    search_k: int = 5
    duplicate_rule: str = "doc_id_and_hash"
    retry_failed: bool = False
    strict_comments: bool = True
    estimate_blank_pages: bool = True
    sheet_source: str | None = None
    table_methods: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.chunk_size < 1 or self.chunk_overlap < 0:
            raise ValueError("chunk_size must be positive and chunk_overlap non-negative")
        if self.chunk_overlap > self.chunk_size:
            raise ValueError("chunk_overlap must not exceed chunk_size")
        if self.duplicate_rule not in ("doc_id_and_hash", "hash"):
            raise ValueError("duplicate_rule is 'doc_id_and_hash' or 'hash'")
