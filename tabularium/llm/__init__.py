"""Operators for preparing training text: extraction, scoring, deduplication, decontamination, mixing."""
