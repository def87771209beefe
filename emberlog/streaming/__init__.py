"""Structured Streaming forms of the log, experiment and alert operators."""
