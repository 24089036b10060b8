"""Structured Streaming jobs and their runner."""

from .jobs import (batch_word_count, hot_goods_stream, hot_search_stream, running_word_count,
                   topic_word_count)
from .runner import StreamTable, read_table, run_available, start_to_table

__all__ = ["batch_word_count", "hot_goods_stream", "hot_search_stream", "running_word_count",
           "topic_word_count", "StreamTable", "read_table", "run_available", "start_to_table"]
