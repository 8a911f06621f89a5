"""Readers, stream sources and sinks."""
