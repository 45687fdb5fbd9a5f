"""Training-data operators: search, packing, extraction, filters, dedup, classifiers, token files."""
