"""Sinks: rolling text and JSON files, JSON tables, Kafka topics."""
