"""Readers, writers and views of corpora."""
