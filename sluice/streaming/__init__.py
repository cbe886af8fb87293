"""Change files and pages as streams."""

from .ingest import drop_reread, stream_changes, stream_checked, stream_texts, stream_upsert, with_arrival

__all__ = ["drop_reread", "stream_changes", "stream_checked", "stream_texts", "stream_upsert", "with_arrival"]
