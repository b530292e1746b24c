"""Training-data operators: search, deduplication, filtering, mixing, packing."""
