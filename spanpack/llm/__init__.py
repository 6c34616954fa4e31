"""Training-data operators: URL rules, page text, fingerprints, toxicity,
sharding, decontamination, near and exact duplicates, licence scans, pieces.

Each module holds one operator with a general interface; ``queries`` binds
them to the given tables. Nothing outside this subpackage imports it.
"""
