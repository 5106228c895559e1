"""Readers, writers and the bindings that derive telemetry tables from the test data."""
