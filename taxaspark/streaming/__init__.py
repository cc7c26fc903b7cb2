"""The row-local commands on streams: filtering, and naming hits by static tables."""

from taxaspark.streaming.hits import filter_stream, filtered_lines, named_hits, start_filter

__all__ = ["filter_stream", "filtered_lines", "named_hits", "start_filter"]
