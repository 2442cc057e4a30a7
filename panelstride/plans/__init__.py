"""Compositions: fixtures derived from the given tables, pipelines, the query registry."""
