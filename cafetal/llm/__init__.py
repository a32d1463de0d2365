"""Training-data operators: search, tokenisation, filtering, deduplication and sharding.

Nothing outside this subpackage imports it; its queries are in ``registry``.
"""
