"""Topics, landed tables and relational tables."""

from cartstream.sources.lake import Lake, open_lake, read_quarantine, read_table, stream_table
from cartstream.sources.relational import FolderTable, JdbcTable
from cartstream.sources.topics import KafkaTopic, TextTopic

__all__ = [
    "FolderTable",
    "JdbcTable",
    "KafkaTopic",
    "Lake",
    "TextTopic",
    "open_lake",
    "read_quarantine",
    "read_table",
    "stream_table",
]
