"""Structured Streaming sinks: drain what is there, checkpoint it, stop."""

from swinglake.streaming.sinks import (
    checkpoint_for, drain, drain_to_batch, for_each_batch, read_batches, union_batches,
    within, write_stream, write_stream_batches,
)

__all__ = [
    "checkpoint_for", "drain", "drain_to_batch", "for_each_batch", "read_batches",
    "union_batches", "within", "write_stream", "write_stream_batches",
]
