"""Sources and sinks."""

from .change_files import read_changes, read_columns, read_mixed, write_changes
from .control import RunMetrics, advance_watermark, control_table, get_watermark, set_watermark, watermarks_or_default
from .pages import check_pages, cursor_faults, failed_pages, number_faults, page_faults, page_nodes, read_nodes, read_pages
from .snapshots import SnapshotDiffers, proved_snapshot, read_snapshot, snapshot_path, snapshot_records, verify_snapshot, write_snapshot
from .tables import Layout, Table, hash_buckets, id_ranges

__all__ = [
    "Layout", "RunMetrics", "SnapshotDiffers", "Table", "advance_watermark", "check_pages", "control_table", "cursor_faults", "failed_pages", "get_watermark",
    "hash_buckets", "id_ranges", "number_faults", "page_faults", "page_nodes", "proved_snapshot", "read_changes", "read_columns", "read_mixed", "read_nodes", "read_pages", "read_snapshot",
    "set_watermark", "snapshot_path", "snapshot_records", "verify_snapshot", "watermarks_or_default", "write_changes", "write_snapshot",
]
