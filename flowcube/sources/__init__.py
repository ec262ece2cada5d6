"""Readers and writers: typed loads, audits of raw input, sinks."""
