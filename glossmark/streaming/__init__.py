"""Streams: an extension."""
