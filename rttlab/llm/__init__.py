"""Training-data operators: quality rules, packing, URL filters, tokens, archives, deduplication, extraction."""
