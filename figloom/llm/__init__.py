"""Operators for training text: splits, overlaps, near-duplicates, pieces, tokens, containers, look-alikes."""
