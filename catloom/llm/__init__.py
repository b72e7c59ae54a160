"""Training-data operators: tokenisation, scans, mixing, deduplication, scoring, sharding."""
