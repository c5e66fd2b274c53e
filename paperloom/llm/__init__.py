"""Training-data operators: filters, near-duplicates, packing, sharding, search."""
