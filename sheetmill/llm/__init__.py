"""Training-data operators: formatting, classifiers, packing, near-duplicate search, tokenisers and quality rules."""
