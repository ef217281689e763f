"""Training-data operators: deduplication, tokenisation, scoring, sharding, archives.

Nothing outside this subpackage imports it.
"""
