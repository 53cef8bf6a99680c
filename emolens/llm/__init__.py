"""Training-data operators: quality rules, deduplication, joins, privacy,
extraction, archives, tokenisation, search and packing.

Nothing else in the library imports this subpackage.
"""
