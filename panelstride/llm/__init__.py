"""Operators for preparing training corpora: deduplication, scoring, fingerprints,
sharding, counting, packing and mixing, each over a table of documents."""
