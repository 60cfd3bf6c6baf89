"""Training-data operators: tokenising, filtering, deduplication, extraction, archives and scoring.

Nothing outside this subpackage imports it.
"""
