"""Operators for preparing training text: scans, tokenizers, duplicates, packing."""
