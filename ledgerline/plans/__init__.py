"""Queries by name: relations derived from the benchmark tables, the operators over them, and SQL twins."""
