"""Incremental work: stages chained through files, and lists that arrive as files."""
