"""Readers, sinks, the mapping spec and stage storage."""
