"""Training-data operators: extraction, filtering, near-duplicates, packing, archives and token files."""
