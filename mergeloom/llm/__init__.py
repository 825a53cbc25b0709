"""Training-data operators (sharding, near-duplicates, filters, codecs, scanners)."""
