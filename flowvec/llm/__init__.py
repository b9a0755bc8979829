"""Training-data operators: deduplication, scans, scoring, tokens and packing."""
