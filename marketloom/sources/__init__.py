"""Readers, the sample-table adapter and sinks."""
