"""Training-data operators: scoring, deduplication, cleaning, tokenising and fingerprinting of text.

Each module holds one operator with its own interface; `queries` registers one query per
operator over the supplied tables. Nothing else in the library imports this subpackage.
"""
