"""Sources: table range scans, event feeds, and adapters over the test tables."""

from tillflow.sources.tables import range_scan, read_table  # noqa: F401
from tillflow.sources.streams import decode_events, read_event_feed, read_kafka_feed, union_feeds  # noqa: F401
