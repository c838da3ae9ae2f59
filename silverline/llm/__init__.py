"""Training-data operators: packing, language id, near-dedup, quality, PII,
toxicity, fingerprints, sharding, mixing and licence scans.

Nothing else in the library imports this package.
"""
