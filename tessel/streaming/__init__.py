"""Structured Streaming entry points.

The reference is batch-only; what carries over to streams is the stateless
range filter (G1), the per-cell spatial aggregate (A9) and the point-in-
rectangle join (J1) against a static rectangle table (a stream-static join on
grid cells planned from the static side).
This package provides the streaming text source and thin helpers that start
those queries with a checkpointed sink.
"""

from tessel.streaming.text_stream import (  # noqa: F401
    grid_counts_stream,
    point_join_stream,
    range_query_stream,
    read_points_stream,
)
