"""Training-data operators: language id, near-duplicates, mixing, sharding, packing,
token counts, n-gram joins, nearest neighbours, toxicity and substring dedup."""
