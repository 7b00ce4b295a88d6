"""Corpus operators: filtering, deduplication, extraction, mixing and packing of training text."""
