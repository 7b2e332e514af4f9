"""Incremental loading of a CSV drop folder with Structured Streaming."""

from finwater.streaming.drop_loader import start_drop_loader  # noqa: F401
