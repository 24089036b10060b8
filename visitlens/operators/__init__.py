"""Batch operators: each takes and returns lazy DataFrames."""

from . import layout, materialize, metrics, partitioning, relational, sessions, text, windows

__all__ = ["layout", "materialize", "metrics", "partitioning", "relational", "sessions", "text",
           "windows"]
