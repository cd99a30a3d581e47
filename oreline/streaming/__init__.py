"""Structured Streaming front ends of the table operators."""

from oreline.streaming.upserts import stream_upsert

__all__ = ["stream_upsert"]
