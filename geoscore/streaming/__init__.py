"""Micro-batch adapters.

The reference is batch only (no watermark, window or state). Its sinks are
append-only or replace whole slices, which makes them safe to drive from
Structured Streaming's ``foreachBatch``: a replayed batch appends the same
rows again only for plain appends, and rewrites the same slices for slice
replacement.
"""

from geoscore.streaming.sinks import append_sink, slice_sink

__all__ = ["append_sink", "slice_sink"]
