"""Streaming sessions: Spark's session_window (closed sessions) and a stateful
processor for early and closed panes; each feed may carry its own watermark."""

from tillflow.streaming.sessions import closed_panes, closed_sessions, mark_feed_time  # noqa: F401
from tillflow.streaming.panes import SessionPanes, as_messages, mark_feed, session_panes_stream  # noqa: F401
