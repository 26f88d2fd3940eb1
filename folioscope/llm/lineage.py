"""Cutting lineage by tables in the shared folder."""

from __future__ import annotations

from ..sinks.shared import release, settle, shared_dir, size_of

__all__ = ["release", "settle", "shared_dir", "size_of"]
