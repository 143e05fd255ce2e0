"""Readers that map raw inputs to the unified event schema, and writers for the outputs."""
