"""Sources: tables, text lines, message-log records, generators."""

from .core import decode_records, generate, generate_stream, table, text_lines

__all__ = ["decode_records", "generate", "generate_stream", "table", "text_lines"]
