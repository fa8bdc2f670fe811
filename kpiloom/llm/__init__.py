"""Operators for preparing text corpora: scoring, filters, token counts, search, packing, deduplication."""
