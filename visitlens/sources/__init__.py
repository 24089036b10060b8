"""Batch and streaming sources."""

from .files import parse_delimited, read_lines, read_table, table_path, write_lines
from .jdbc import read_jdbc
from .sinks import write_jdbc, write_table
from .streams import parquet_stream, parquet_table_stream, socket_lines, text_dir_stream, topic_stream

__all__ = ["parse_delimited", "read_lines", "read_table", "table_path", "read_jdbc", "write_jdbc", "write_lines", "write_table",
           "parquet_stream", "parquet_table_stream", "socket_lines", "text_dir_stream", "topic_stream"]
