"""Training-data pipeline operators: secrets, near-duplicates, quality, PII, BPE, packing and search.

Nothing else in the library imports this subpackage.
"""
