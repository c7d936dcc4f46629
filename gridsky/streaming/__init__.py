"""Structured Streaming: keyed sinks and the multi-sink job."""
