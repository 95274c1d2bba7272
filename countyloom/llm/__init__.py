"""Operators for building training corpora: sharding, search, filters, mixing, deduplication, classifiers, packing."""
