"""Training-data operators: dedup, cleaning, tokenising, search, scoring, sharding, chat and packing."""
