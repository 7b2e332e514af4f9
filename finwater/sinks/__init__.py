"""Targets of loads."""

from finwater.sinks.versioned import commit, current, history, read_version, remove_superseded, stage

__all__ = ["commit", "current", "history", "read_version", "remove_superseded", "stage"]
