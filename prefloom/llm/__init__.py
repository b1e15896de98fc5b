"""Training-data operators: deduplication, scoring, mixing, fingerprints and tokens."""
