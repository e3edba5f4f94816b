"""Operators for preparing training text: scoring, sharding, fingerprints,
near-duplicates, licence scans, mixing, nearest vectors and tokens.

Nothing outside this subpackage imports it (``__spark_entry__`` adds its
queries only where it is present)."""
