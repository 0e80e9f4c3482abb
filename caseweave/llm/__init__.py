"""Operators for preparing training corpora: fingerprints, near and exact copies, packing, mixing, filters."""
