"""Compositions of operators: the registered query catalog and the end-to-end run."""
