"""Typed readers and sinks."""
