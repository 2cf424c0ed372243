"""Training-data operators: deduplication, filtering, tokenising, redaction and sharding of text tables."""
