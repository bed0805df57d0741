"""Sources: message tables/streams, the dimension table, text, given tables."""

from eventlake.sources.dims import fixture_dimension, read_dimension, read_dimension_or_empty
from eventlake.sources.messages import (kafka_to_messages, messages_from_events, read_messages,
                                        read_message_stream)
from eventlake.sources.tables import load_table, read_text

__all__ = [
    "fixture_dimension", "read_dimension", "read_dimension_or_empty", "kafka_to_messages",
    "messages_from_events", "read_messages", "read_message_stream", "load_table", "read_text",
]
