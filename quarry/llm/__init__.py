"""Training-data operators: classification, deduplication, tokenisation, filters."""
