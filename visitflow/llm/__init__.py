"""Operators for large text corpora: quality, tokens, packing, decontamination, deduplication,
extraction, privacy and search.  Nothing else in the library imports this subpackage."""
