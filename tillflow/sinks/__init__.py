"""Sinks: append to an existing table (batch), write panes from a stream."""

from tillflow.sinks.tables import append_to_table, conform  # noqa: F401
from tillflow.sinks.streams import write_batches_idempotent, write_files, write_kafka  # noqa: F401
