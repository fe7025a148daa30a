"""Sinks: CSV files, Kafka payloads, Redis hashes, JDBC upserts, labelled console output."""
