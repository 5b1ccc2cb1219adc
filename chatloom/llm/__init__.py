"""Training-data operators: deduplication, mixing, packing, formatting, extraction, quality."""
