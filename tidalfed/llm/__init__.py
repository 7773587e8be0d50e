"""Operators for preparing training text: duplicates, classifiers, mixing, packing, shards."""
