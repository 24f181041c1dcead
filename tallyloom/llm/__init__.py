"""Training-data operators: scoring, filtering, deduplication, search and packing of documents."""
