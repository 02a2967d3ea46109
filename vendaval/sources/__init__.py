"""Sources and sinks."""

from vendaval.sources.events import (
    decode_events,
    encode_events,
    publish_kafka,
    read_event_files,
    read_kafka,
)
from vendaval.sources.files import empty, read_or_empty, read_snapshots
from vendaval.sources.frames import FrameSource
from vendaval.sources.jdbc import JdbcSource

__all__ = [
    "FrameSource",
    "JdbcSource",
    "decode_events",
    "empty",
    "encode_events",
    "publish_kafka",
    "read_event_files",
    "read_kafka",
    "read_or_empty",
    "read_snapshots",
]
