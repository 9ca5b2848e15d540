"""Sinks: the table, the CSV reports, the samples."""
