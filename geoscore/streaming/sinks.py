"""``foreachBatch`` functions over the table sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from geoscore.sources import tables


def append_sink(path: str, partition_by: list[str] | None = None,
                transform: Callable[[DataFrame], DataFrame] | None = None, stream: str | None = None):
    """Each micro-batch (optionally transformed) is appended to ``path``. With
    ``stream``, a name for the stream, a replayed micro-batch replaces its own
    rows (table column ``batch``), so each is there once."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        tables.append(out, path, partition_by, None if stream is None else f"{stream}-{batch_id}")
    return run


def slice_sink(path: str, slice_cols: list[str],
               transform: Callable[[DataFrame], DataFrame] | None = None):
    """Each micro-batch replaces the slices it contains (idempotent on replay)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch) if transform else batch
        tables.replace_slices(out, path, slice_cols)
    return run
