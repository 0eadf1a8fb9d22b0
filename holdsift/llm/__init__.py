"""Operators of a training-data pipeline over corpus tables (documents, pages, labels)."""
