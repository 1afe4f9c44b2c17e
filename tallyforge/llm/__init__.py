"""Training-data operators: packing, filtering, deduplication, counting and scoring of text corpora.

Nothing outside this subpackage imports it.
"""
