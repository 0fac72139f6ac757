"""Operators that prepare text for training: scoring, scanning, near-duplicates, mixing and packing."""
