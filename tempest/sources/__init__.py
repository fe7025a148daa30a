"""Sources: text and CSV files (batch and stream), in-memory rows, Kafka, and a seeded generator."""
