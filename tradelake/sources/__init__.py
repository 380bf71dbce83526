"""Readers."""

from tradelake.sources.lake import read_dim, read_event_stream, read_raw, replay, union_evolving

__all__ = ["read_dim", "read_event_stream", "read_raw", "replay", "union_evolving"]
