"""Data-quality checks, entity matching, migration and reconciliation on Spark."""
