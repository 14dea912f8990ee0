"""Operators for building training corpora: deduplication, filtering, scanning, packing and search over documents."""
