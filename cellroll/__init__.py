"""cellroll: load, check, join, publish and roll up wide cell-counter feeds on Spark."""

from .operators.combine import feed_join, feed_join_audit, unmatched_keys
from .operators.publish import first_wins, insert_ignore, insert_ignore_into, new_only
from .operators.quality import cell_key_collisions, duplicate_keys, quality_report
from .operators.rollup import bucket_rollup, daily_rollup, daily_rows, sum_metrics
from .operators.stats import load_totals, observe_line_totals
from .plans.full_load import LoadError, LoadReport, run_load
from .schema import CellKey, FeedSpec, cell_feed_spec, metric_names, metrics_of, table_spec
from .session import build_session, scratch_path
from .sources.feed import Feed, load_feed, parse_lines
from .sources.lines import read_lines
from .streaming.incremental import run_incremental, write_manifest

__all__ = [
    "CellKey", "Feed", "FeedSpec", "LoadError", "LoadReport", "bucket_rollup", "build_session",
    "cell_feed_spec", "cell_key_collisions", "daily_rollup", "daily_rows", "duplicate_keys",
    "feed_join", "feed_join_audit", "first_wins", "insert_ignore",
    "insert_ignore_into", "load_feed", "load_totals", "metric_names", "metrics_of", "new_only", "observe_line_totals",
    "parse_lines", "quality_report", "read_lines", "run_incremental", "run_load",
    "scratch_path", "sum_metrics", "table_spec", "unmatched_keys", "write_manifest",
]
