"""Operators for training-data corpora: dedup, decontamination, tokens, scoring, archives, search."""
