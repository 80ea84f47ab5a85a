"""Training-data operators: filters, packing, tokenising, extraction, media, near-duplicates, sharding, language."""
