"""Assembled jobs: exports, publication, profiling and the registered queries."""
