"""Operators for preparing training text: PII, scoring, de-duplication, packing, quality, search, mixing, extraction."""
