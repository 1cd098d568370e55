"""Training-data operators: scoring, filtering, deduplication, mixing and encoding of text corpora.

Nothing else in the library imports this subpackage.
"""
