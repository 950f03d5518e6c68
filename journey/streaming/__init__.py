"""Session stage flags maintained incrementally from a stream of events.

The original project has no streaming; this only re-uses the session-flag
core (one ``max(case when …)`` row per session) on a Structured Streaming
source, so the funnel operators can run over flags that are kept up to date.
"""

from journey.streaming.session_stream import flags_sink, funnel_from_flags, stream_session_flags

__all__ = ["stream_session_flags", "flags_sink", "funnel_from_flags"]
