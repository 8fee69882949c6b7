"""Training-data operators: search, packing, extraction, filtering, dedup, sharding, scoring and mixing."""
