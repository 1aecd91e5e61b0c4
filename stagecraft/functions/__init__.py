"""Column functions: path key, listing time, report text, time differences, size lookup."""

from .paths import last_modified_to_timestamp, parent_dir, stage_path_shorten, timestamp_to_listing_text
from .text import progress_bar, thousands_text
from .timing import minutes_between, ntz_literal, seconds_between
from .warehouse import nodes_per_warehouse

__all__ = [
    "last_modified_to_timestamp", "parent_dir", "stage_path_shorten", "timestamp_to_listing_text",
    "progress_bar", "thousands_text", "minutes_between", "ntz_literal", "seconds_between",
    "nodes_per_warehouse",
]
