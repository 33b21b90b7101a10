"""Training-data operators: deduplication, packing, search, scoring and archives."""
