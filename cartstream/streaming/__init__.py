"""Structured Streaming: landing, export, live panels, supervision."""

from cartstream.streaming.ingest import (
    AVAILABLE_NOW,
    start_export,
    start_items,
    start_landing,
)
from cartstream.streaming.keys import start_keys
from cartstream.streaming.live import read_live, start_live
from cartstream.streaming.supervise import StreamsFailed, supervise

__all__ = [
    "AVAILABLE_NOW",
    "StreamsFailed",
    "read_live",
    "start_export",
    "start_items",
    "start_keys",
    "start_landing",
    "start_live",
    "supervise",
]
