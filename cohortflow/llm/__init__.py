"""Training-data operators: scoring, filtering, deduplication, tokenising and packing of a documents table."""
