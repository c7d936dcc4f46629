"""Readers and writers: message streams, landed documents, series and serving tables."""
