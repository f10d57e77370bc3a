"""Training-data operators: fingerprints, shards, quality, reputation, near copies, mixing, language, leaks, codes, scores.

Nothing else in the package imports this subpackage.
"""
