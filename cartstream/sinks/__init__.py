"""Writers that are not streams."""

from cartstream.sinks.compact import compact, compact_closed
from cartstream.sinks.publish import to_messages

__all__ = ["compact", "compact_closed", "to_messages"]
