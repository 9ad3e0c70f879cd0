"""Operators of a training-data pipeline: quality, duplicates, tokens, PII.

Every operator takes a ``documents``-like frame (``doc_id``, ``text``; other
columns are ignored) and returns a frame. Nothing else in the library imports
this subpackage.
"""
