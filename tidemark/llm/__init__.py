"""Training-data operators: extraction, language, quality, deduplication, tokens, packing and search.

Nothing outside this subpackage imports it.
"""
