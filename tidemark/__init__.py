"""tidemark: dynamic thresholds (MA, banded WMA, EWMA limits) for metric series on Spark."""

from tidemark.functions.weights import band_bounds, band_weight, denominator, parse_weights
from tidemark.operators.models import (
    describe_summary,
    ewma_limits,
    model_table,
    moving_average,
    threshold,
    weighted_moving_average,
)
from tidemark.operators.recent import latest_n, recency_rank, restrict_to_newest_keys
from tidemark.operators.reshape import (
    business_day_index,
    chunk_blocks,
    row_positions,
    summary_to_long,
    transpose,
)
from tidemark.operators.windows import sliding_aggregate, window_count, window_latest_n, window_threshold
from tidemark.sources.records import decode_records, decode_vector, project_record, read_metric_file

__version__ = "0.1.0"

__all__ = [
    "band_bounds", "band_weight", "business_day_index", "chunk_blocks", "decode_records",
    "decode_vector", "denominator", "describe_summary", "ewma_limits", "latest_n", "model_table",
    "moving_average", "parse_weights", "project_record", "read_metric_file", "recency_rank",
    "restrict_to_newest_keys", "row_positions", "sliding_aggregate", "summary_to_long", "threshold",
    "transpose", "weighted_moving_average", "window_count", "window_latest_n", "window_threshold",
]
