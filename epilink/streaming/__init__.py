"""Streaming harmonisation."""

from .harmonize import SourceConfig, default_sources, harmonize, harmonize_stream, run_all, tee_console, topic_location, unparsed, write_batches, write_stream
