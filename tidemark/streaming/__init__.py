from tidemark.streaming.landing import dedupe_events, landing_stream, stream_landing

__all__ = ["dedupe_events", "landing_stream", "stream_landing"]
