"""Streams: polling, upserts, channels, supersteps, event-time windows."""
