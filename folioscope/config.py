"""Settings, with their defaults. Parsed from a mapping such as os.environ; a value that doesn't parse falls back to the default."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields
from datetime import date


@dataclass(frozen=True)
class Settings:
    days_back: int = 7
    window_end_date: date | None = None
    edition_id: date | None = None
    min_abstract_chars: int = 80
    min_edition_papers: int = 50
    min_summary_words: int = 6
    min_selection_fraction: float = 0.50
    classifier_score_threshold: int = 50
    max_ai_failure_fraction: float = 0.05
    max_ai_failure_count: int = 5
    recall_min_local_score: float = 0.05
    score_policy_version: str = "human-feedback-v2"
    feedback_top: int = 12
    classifier_partitions: int = 4
    repair_partitions: int = 2
    max_cost_usd: float = 5.0
    max_requests: int = 2000
    input_usd_per_million: float = 1.50
    output_usd_per_million: float = 7.50
    cost_safety: float = 1.25
    reserved_output_tokens: int = 1024
    request_retries: int = 3
    max_backoff_seconds: int = 20

    @classmethod
    def read(cls, values: Mapping[str, str]) -> Settings:
        found = {}
        for f in fields(cls):
            raw = (values.get(f.name.upper()) or "").strip()
            if not raw:
                continue
            if f.name in ("window_end_date", "edition_id"):
                try:
                    found[f.name] = date.fromisoformat(raw)
                except ValueError:
                    raise ValueError(f"{f.name.upper()} must be YYYY-MM-DD, not {raw!r}") from None
                continue
            try:
                found[f.name] = {"int": int, "float": float}.get(str(f.type), str)(raw)
            except ValueError:
                continue
        return cls(**found)
