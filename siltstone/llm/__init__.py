"""Training-data operators: filters, deduplication, mixing, packing, formatting, sharding."""
