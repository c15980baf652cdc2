"""Structured Streaming: incremental insert-ignore / append loads of new source files."""

from martsmith.streaming.incremental import incremental_load

__all__ = ["incremental_load"]
